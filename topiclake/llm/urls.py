"""URL filter: rules for hosts and paths, and trust that spreads over links between hosts.

Rules decide first, the longest one that fits.  Every other page takes the verdict of its
host.  Hosts are scored by two personalised PageRanks over the links between them: trust starts
at hosts whose pages the rules allow and follows links; distrust starts at hosts whose
pages the rules block and goes against links, to those that link there.  A host starts
with the share of its pages that were ruled so.  It is blocked when its distrust is above its trust by half
of what a host gets that is blocked as a whole.

Distrust is counted in two ways, and the larger counts.  A host deals its distrust out to those that link
to it, so each of many gets little.  Reach is the distrust of the hosts that a host links to, each by
its part of the host's links: a host that links to one blocked host and nowhere else gets the same however many
others link there too.  Rounds go on until what is still on its way can move no host by more
than a tolerance.

Everything is DataFrame operations.  Links are counted per pair of hosts before they are
shuffled, pages join their host's score without their html, and each round's scores are written.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from topiclake.llm.tables import counted_side, written

DAMPING = 0.85
#: rounds of the SQL; the operator goes on until the scores are settled
ROUNDS = 8
#: distrust less trust, as a part of what a wholly blocked host starts with
THRESHOLD = 0.5
#: what the scores may still lack, in the same unit
TOLERANCE = 0.001

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"(?i)href\s*=\s*[\"']?\s*([^\"'\s>]+)"


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


# fixed values: the rules of the query
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host in lower case A-Z and the path; both empty for NULL and for texts without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def _ruled(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    host, path = host_and_path(F.coalesce(F.col("url").cast("string"), F.lit("")))
    # the longest rule first; of two as long, the one named first
    ordered = sorted(rules, key=lambda r: -len(r.text))
    h, p = F.col("host"), F.col("path")
    pick = lambda what: F.coalesce(*[F.when(r.fits(h, p), F.lit(what(r))) for r in ordered], F.lit(None).cast("string"))
    return (
        pages.select("page_id", host.alias("host"), path.alias("path"), "html")
        .withColumn("rule", pick(lambda r: r.text))
        .withColumn("ruled", pick(lambda r: r.verdict))
    )


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, links) between different hosts, from the href attributes of ``pages`` (host, html)."""
    link = pages.select("host", F.explode(F.regexp_extract_all("html", F.lit(_LINK), 1)).alias("link"))
    # a link without scheme stays on its host
    whole = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    outward = link.withColumn("link", whole).where(F.col("link").rlike("^[A-Za-z][A-Za-z0-9+.-]*://"))
    target, _ = host_and_path(F.col("link"))
    named = outward.select(F.col("host").alias("source"), target.alias("target"))
    return named.where("source <> target and source <> '' and target <> ''").groupBy("source", "target").agg(F.count("*").alias("links"))


_SCORES = ("trust", "distrust", "reach")


def _unsettled(term: DataFrame, damping: float) -> float:
    """The most that all rounds after that of ``term`` can add to a score of a host."""
    # trust and distrust may all meet at one host; a reach is a mean of others
    mass = term.agg(F.sum("trust"), F.sum("distrust"), F.max("reach")).first()
    return max(m or 0.0 for m in mass) * damping / (1 - damping)


def _spread(seeds: DataFrame, links: DataFrame, rounds: int | None, damping: float, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust, reach) after ``rounds`` rounds, or once settled; ``seeds``: (host, trust, distrust)."""
    out = links.groupBy("source").agg(F.sum("links").alias("out"))
    into = links.groupBy("target").agg(F.sum("links").alias("into"))
    edges = written(
        links.join(out, "source").join(into, "target").select(
            "source", "target", (F.col("links") / F.col("out")).alias("follow"), (F.col("links") / F.col("into")).alias("back")
        ),
        "links",
    )
    start = seeds.withColumn("reach", F.col("distrust")).select("host", *[((1 - damping) * F.col(c)).alias(c) for c in _SCORES])
    sums = [F.sum(c).alias(c) for c in _SCORES]
    # what each round adds; the scores are the sums
    terms, term = [start], start
    while len(terms) <= rounds if rounds is not None else _unsettled(term, damping) > tolerance * (1 - damping):
        followed = edges.join(term, edges["source"] == term["host"]).select(
            F.col("target").alias("host"), (damping * F.col("trust") * F.col("follow")).alias("trust"), F.lit(0.0).alias("distrust"), F.lit(0.0).alias("reach")
        )
        went_back = edges.join(term, edges["target"] == term["host"]).select(
            F.col("source").alias("host"), F.lit(0.0).alias("trust"), (damping * F.col("distrust") * F.col("back")).alias("distrust"), (damping * F.col("reach") * F.col("follow")).alias("reach")
        )
        term = written(followed.unionByName(went_back).groupBy("host").agg(*sums).where("trust > 0 or distrust > 0 or reach > 0"), "ranks")
        terms.append(term)
    return reduce(DataFrame.unionByName, terms).groupBy("host").agg(*sums)


def judge(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int | None = None, damping: float = DAMPING, threshold: float = THRESHOLD
) -> DataFrame:
    """``pages`` (page_id, url, html, any others) -> page_id, host, path, rule, verdict.

    A page without a host has no rule and is allowed; NULL html has no links; repeated rows and
    NULL ids get a row each.  An empty table gives an empty result.  Pages of any length are read whole, other columns not at
    all, whatever their names.  Without ``rounds`` the scores
    are spread until they are settled.
    """
    ruled = _ruled(pages, rules)
    share = lambda verdict: F.avg((F.coalesce("ruled", F.lit("")) == verdict).cast("double"))
    seeds = written(
        ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")), "seeds"
    )
    links = written(host_links(ruled.select("host", "html")), "links")
    # without links between hosts the scores stay where they start
    scores = _spread(seeds, links, 0 if links.isEmpty() else rounds, damping)
    # written, so that pages of a host that holds many of them can be split over tasks
    blocked = scores.where(F.greatest("distrust", "reach") - F.col("trust") > threshold * (1 - damping)).select("host", F.lit("block").alias("spread"))
    blocked = counted_side(written(blocked, "blocked"))
    verdict = F.coalesce("ruled", "spread", F.lit("allow"))
    return ruled.drop("html").join(blocked, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
