"""Line dedup: an exact set-similarity join of lines, with DataFrame operations only.

A line is the set of its SHINGLE-word shingles, known by 64-bit hashes; a line of fewer words, one at least, has all
its words as its one token.  A line goes when an earlier one, by doc_id and line number, has a Jaccard similarity of
LINK / OF or more.  With a similarity t two lines share a token among the first
``n - ceil(t n) + 1`` tokens of each in any one order, so:

1. Equal lines are brought together first, by hash; from here on a line is there once.  Lines of few words are similar
   only if their words are equal, so their words are what is hashed, and this is all they need.
2. A first filter takes the order of the hashes, needs no counts, and keeps the lines that
   share TOGETHER of their first tokens with others.  Most lines end here.
3. The lines that are left keep the order of the hashes, but tokens that many of them would list
   come last, by rarity.  Their first tokens are joined under the length filter and the
   positional filter (tokens from a shared one on must be enough), and the full sets decide.
4. A list of lines with a common token is first compared with its earliest line.  Lines
   that are still open are compared with all earlier ones: short lists as pairs, long ones inside
   the join, where a pair is looked at only at the first token that the two share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from topiclake.llm.tables import as_row, counted_side, row_key, scratch, with_text, written

SHINGLE = 5
LINK, OF = 75, 100
#: members of a list that are compared as pairs
SHORT = 32
#: lines that may list a token before it is put behind the others
USUAL = 8
#: rows of these lists that are sent to every task, as they are sent several times
_FEW_ROWS = 100_000
#: first tokens that a line must share to get past the first filter
TOGETHER = 4

_BLANKS = "\t\r\u000b\f"


def _words(line: Column) -> Column:
    # most lines have single blanks between words only, and need no more than a split
    odd = line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    for blank in _BLANKS:
        odd = odd | line.contains(blank)
    every = F.array_remove(F.split(F.translate(line, _BLANKS, "    "), " "), "")
    return F.when(odd | (line == ""), every).otherwise(F.split(line, " "))


def _first(n: Column) -> Column:
    """How many tokens of a line of ``n`` another one of the similarity shares one of."""
    return (n - F.ceil(n * LINK / OF) + 1).cast("int")


def _parts(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_key, line_no, line) of every line."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = text.select("doc_id", row_key().alias("doc_key"), F.split("text", "\n").alias("parts"))
    # a split is never empty; without the word outer it would be made twice to check that
    return keyed.select("doc_id", "doc_key", F.posexplode_outer("parts").alias("line_no", "line"))


def _lines(docs: DataFrame) -> DataFrame:
    """Every line with a word: name, check, place, the line itself, and whether it has SHINGLE words or more."""
    # stops at the last of these words, most lines go on
    every = _parts(docs).where(F.col("line").rlike(r"\S")).withColumn("long", F.col("line").rlike(rf"^\s*(?:\S+\s+){{{SHINGLE - 1}}}\S"))
    same = F.when(F.col("long"), F.col("line")).otherwise(F.array_join(_words(F.col("line")), " "))
    return every.select(*_name(same), _place().alias("place"), "line", "long")


def _with_tokens(lines: DataFrame) -> DataFrame:
    """Replace the line by its distinct shingle hashes, in the order of the hashes; nothing of a line of few words is to be used."""
    hashed = lines.withColumn("hashes", F.transform(_words(F.col("line")), lambda w: F.xxhash64(w))).drop("line")
    tokens = F.transform("hashes", lambda h, i: F.xxhash64(h, *[F.get("hashes", i + k) for k in range(1, SHINGLE)]))
    # the last words begin no shingle; a slice outside of transform is compiled, and copies numbers as they are
    tokens = F.slice(tokens, 1, F.greatest(F.lit(0), F.size("hashes") - (SHINGLE - 1)))
    return hashed.withColumn("tokens", F.sort_array(F.array_distinct(tokens))).drop("hashes")


_PLACE = ["doc_id", "doc_key", "line_no"]


#: the lowest bits of a name are free: how many first tokens a line must share fits there
_SPARE = TOGETHER.bit_length() - 1
#: bits of the tokens that the first filter looks at; two that fall together only mean a candidate more
_TOKEN_BITS = 48
#: parts of the tokens that the first filter takes one after another, so that only one part is on disk
_PASSES = 3


def _name(line: Column) -> list[Column]:
    """Equal lines have equal names; 126 bits in all."""
    return [F.xxhash64(line).bitwiseAND(F.lit(-(1 << _SPARE))).alias("name"), F.xxhash64(F.lit(1), line).alias("check")]


def _place() -> Column:
    """Where a line stands; NULL ids come after all others."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), *_PLACE)


def _enough(n: str, other: str) -> Column:
    return OF * F.least(n, other) >= LINK * F.greatest(n, other)


def _positions_allow() -> Column:
    """What two lines can share from these positions (from 0) on must reach the similarity."""
    most = F.least(F.col("n") - F.col("position"), F.col("o_n") - F.col("o_position"))
    # shared tokens before the position are at most the smaller position
    most = most + F.least("position", "o_position")
    return (OF + LINK) * most >= LINK * (F.col("n") + F.col("o_n"))


def _similar(left: Column, right: Column) -> Column:
    common = F.size(F.array_intersect(left, right))
    return (OF + LINK) * common >= LINK * (F.size(left) + F.size(right))


def _needed(n: Column) -> Column:
    """How many of its first tokens a line of ``n`` must share with another one: TOGETHER, or all that must be common."""
    return F.least(F.lit(TOGETHER), F.ceil(n * LINK / OF).cast("int"))


def _posted(lines: DataFrame) -> DataFrame:
    """name, check, place, chars of all lines; those of SHINGLE words or more with their ``first`` tokens, in the order of hashes, and ``need``.

    A similar line has all but ``n - ceil(t n)`` tokens too, so so many more than those hold
    TOGETHER of the common ones, or all there must be.
    """
    n, need = F.size("tokens"), _needed(F.size("tokens"))
    first = F.slice("tokens", 1, n - F.ceil(n * LINK / OF).cast("int") + need)
    every = _with_tokens(lines.withColumn("chars", F.length("line").cast("long")))
    return every.select(
        "name", "check", "place", "chars", F.when(F.col("long"), first).alias("first"), F.when(F.col("long"), need).cast("byte").alias("need")
    )


def _candidates(posted: DataFrame, copied: DataFrame) -> DataFrame:
    """The names of lines that share as many of their first tokens as they need with others.

    ``copied`` are the names that stand several times: those are looked at once.
    """
    long = posted.where("first IS NOT NULL").select("name", "check", "first", "need")
    once = long.join(copied, ["name", "check"], "left_anti")
    some = written(long.join(copied, ["name", "check"], "left_semi").dropDuplicates(["name", "check"]), "some")
    # two lines of one name only mean a candidate more; need - 1 stands in the name's free bits
    marked = F.col("name").bitwiseOR(F.col("need").cast("long") - 1).alias("name")
    each = once.unionByName(some).select(marked, F.explode("first").alias("token"))
    each = each.withColumn("token", F.col("token").bitwiseAND(F.lit((1 << _TOKEN_BITS) - 1)))
    found = None
    for turn in range(_PASSES):
        part = each.where(F.col("token") % _PASSES == turn).repartition("token")
        # the name is read here too, so that both sides are one and the same shuffle
        shared = part.groupBy("token").agg(F.count("*").alias("n"), F.min("name").alias("any"))
        shared = shared.where("n > 1 AND any IS NOT NULL").select("token")
        # the tokens that are shared are few and spread evenly: they are looked up, and nothing is sorted
        # (a semi join would be moved below the shuffle)
        counted = part.join(shared.hint("shuffle_hash"), "token").groupBy("name").agg(F.count("*").alias("n"))
        counted = written(counted, "counted")
        found = counted if found is None else found.unionByName(counted)
    total = found.groupBy("name").agg(F.sum("n").alias("n"))
    spare = F.lit((1 << _SPARE) - 1)
    return total.where(F.col("n") > F.col("name").bitwiseAND(spare)).select(F.col("name").bitwiseAND(F.lit(-(1 << _SPARE))).alias("name")).distinct()


def _ranked(lines: DataFrame, usual: int) -> DataFrame:
    """(token, line, n, position, place) for the first tokens of each line, in one order for all lines.

    Tokens come in the order of the hashes, but those that more than ``usual`` lines would list so come last, rarest first.
    Only the lines that list one of these are ordered anew.
    """
    n = F.size("tokens")
    first = F.slice("tokens", 1, _first(n))
    listed = written(lines.select("line", n.alias("n"), "place", F.posexplode(first).alias("position", "token")), "listed")
    def many(tokens: DataFrame, purpose: str) -> DataFrame:
        counts = tokens.groupBy("token").agg(F.count("*").alias("df")).where(F.col("df") > usual)
        return counted_side(written(counts, purpose), _FEW_ROWS)

    def having(tokens: DataFrame, purpose: str) -> tuple[DataFrame, DataFrame]:
        some = counted_side(written(listed.join(tokens, "token", "left_semi").select("line").distinct(), purpose), _FEW_ROWS)
        return some, lines.join(some, "line", "left_semi").select("line", n.alias("n"), "place", F.explode("tokens").alias("token"))

    # the other tokens of these lines are counted too, else those that come next may be just as frequent
    often = many(having(many(listed, "listed_often"), "open")[1], "often")
    again, every = having(often, "again")
    known = every.join(often, "token", "left")
    rank = F.row_number().over(Window.partitionBy("line").orderBy(F.coalesce("df", F.lit(0)), "token")) - 1
    ordered = known.withColumn("position", rank).where(F.col("position") < _first(F.col("n")))
    columns = ["token", "line", "n", "position", "place"]
    return listed.join(again, "line", "left_anti").select(columns).unionByName(ordered.select(columns))


def _others(frame: DataFrame) -> DataFrame:
    return frame.select("token", *[F.col(c).alias(f"o_{c}") for c in frame.columns if c != "token"])


def _verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The lines of ``pairs`` (line, o_line) that are similar to the other one."""
    mine = lines.select("line", "tokens")
    other = lines.select(F.col("line").alias("o_line"), F.col("tokens").alias("o_tokens"))
    both = pairs.join(mine, "line").join(other, "o_line")
    return both.where(_similar(F.col("tokens"), F.col("o_tokens"))).select("line").distinct()


def _later(lines: DataFrame, short: int, usual: int) -> DataFrame:
    """(line) of those that are similar to an earlier one; ``lines``: line, place, tokens."""
    ranked = written(_ranked(lines, usual), "ranked")
    allowed = (F.col("place") > F.col("o_place")) & _enough("n", "o_n") & _positions_allow()
    earliest = ranked.groupBy("token").agg(
        F.min(F.struct("place", "line", "n", "position")).alias("e"), F.count("*").alias("members")
    )
    heads = earliest.where("members > 1").select("token", "members", *[F.col(f"e.{c}").alias(f"o_{c}") for c in ("line", "n", "position", "place")])
    shared = written(ranked.join(heads, "token"), "shared")
    stars = written(shared.where(allowed).select("line", "o_line").distinct(), "stars")
    gone = written(_verified(stars, lines), "gone")
    # lists of two are done; the lines that are gone ask no more, but still answer
    answer = shared.where("members > 2").select("token", "line", "n", "position", "place", "members")
    ask = answer.join(gone, "line", "left_anti")
    few = ask.where(F.col("members") <= short).drop("members")
    pairs = few.join(_others(answer.drop("members")), "token").where(allowed).select("line", "o_line").distinct()
    pairs = pairs.join(stars, ["line", "o_line"], "left_anti")
    found = gone.unionByName(_verified(written(pairs, "pairs"), lines))
    many = written(ask.where(F.col("members") > short).drop("members"), "open")
    if many.isEmpty():
        return found
    # in long lists the sets come along, and only links leave the join; lists of one line are no list to meet in
    listed = shared.groupBy("line").agg(F.collect_list(F.struct("position", "token")).alias("l"))
    sets = lines.select("line", "tokens").join(listed.select("line", F.transform(F.array_sort("l"), lambda x: x["token"]).alias("listed")), "line")
    long = answer.where(F.col("members") > short).drop("members").join(sets, "line")
    here = F.element_at(F.array_intersect("listed", "o_listed"), 1) == F.col("token")
    similar = _similar(F.col("tokens"), F.col("o_tokens"))
    met = many.join(sets, "line").join(_others(long), "token").where(allowed & here & similar).select("line")
    return found.unionByName(met.distinct())


def removed_lines(docs: DataFrame, short: int = SHORT, usual: int = USUAL) -> DataFrame:
    """(doc_key, removed, lost): the numbers, from 0, of the lines that go, and their characters, for documents that lose any;
    a written table.

    doc_key is ``xxhash64(doc_id, text)``, with '' for a NULL text.  Order is by doc_id, doc_key
    and line number; NULL ids come last.  Rows that are equal in doc_id and text are one document.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(_gone(docs, short, usual), "removed")


def _asked(lines: DataFrame, keep) -> tuple[DataFrame, DataFrame]:
    """(name, check, place, chars) of the lines that stand several times or are candidates, and the candidates' names."""
    posted = written(_posted(lines), "posted")
    places = posted.select("name", "check", "place", "chars")
    copied = written(places.groupBy("name", "check").agg(F.count("*").alias("n")).where("n > 1").select("name", "check"), "copied")
    wanted = counted_side(keep(_candidates(posted, counted_side(copied)), "wanted"))
    # a line that stands once and is no candidate stays
    asked = places.join(wanted, "name", "left_semi").unionByName(
        places.join(wanted, "name", "left_anti").join(counted_side(copied), ["name", "check"], "left_semi")
    )
    return keep(asked, "asked"), wanted


def _gone(docs: DataFrame, short: int, usual: int) -> DataFrame:
    lines = _lines(docs)
    # the first tokens of all lines are by far the largest table, and go before the sets are made
    with scratch(docs.sparkSession) as keep:
        asked, wanted = _asked(lines, keep)
    least = written(asked.groupBy("name", "check").agg(F.min("place").alias("first"), F.count("*").alias("copies")), "least")
    # the text of a line that is wanted, from its first place
    where = least.join(wanted, "name", "left_semi").select("name", "check", "first")
    # a wanted line has SHINGLE words or more, and so its name is made of the line as it is
    name, check = _name(F.col("line"))
    named = _parts(docs).withColumn("name", name).join(wanted, "name", "left_semi").select("name", check, _place().alias("place"), "line")
    some = named.join(where, ["name", "check"]).where(F.col("place") == F.col("first"))
    named = some.select(F.xxhash64("name", "check").alias("line_id"), "name", "check", "place", "line")
    full = _with_tokens(named.dropDuplicates(["line_id"])).withColumnRenamed("line_id", "line")
    full = written(full, "lines")
    later = written(_later(full.select("line", "place", "tokens"), short, usual).distinct(), "later")
    fuzzy = full.join(later, "line", "left_semi").select("name", "check", F.lit(True).alias("goes"))
    # all places of lines that are similar to an earlier one, and all but the first of the others
    known = least.join(fuzzy, ["name", "check"], "left").where("copies > 1 or goes")
    marked = asked.join(counted_side(written(known.drop("copies"), "known")), ["name", "check"])
    gone = marked.where(F.coalesce("goes", F.col("place") != F.col("first")))
    # rows that are equal in doc_id and text are one document
    each = F.collect_set(F.struct("place.line_no", "chars")).alias("each")
    found = gone.groupBy(F.col("place.doc_key").alias("doc_key")).agg(each).withColumn("each", F.array_sort("each"))
    lost = F.aggregate("each", F.lit(0).cast("long"), lambda n, x: n + x["chars"])
    return found.select("doc_key", F.col("each.line_no").alias("removed"), lost.alias("lost"))


def without_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` with the removed lines taken out of text, and without documents that have no word left."""
    keyed = docs.select(as_row(docs).alias("row"), row_key().alias("doc_key"))
    # a written table, so that a key that many rows share can be split over tasks; never fetched, so it is the same at every size
    joined = keyed.join(removed, "doc_key", "left")
    whole = F.col("row")["text"]
    kept = F.filter(F.split(whole, "\n"), lambda line, i: ~F.array_contains("removed", i))
    changed = F.col("removed").isNotNull()
    text = F.when(changed, F.array_join(kept, "\n")).otherwise(whole)
    emptied = changed & (F.size(_words(F.translate(F.array_join(kept, " "), "\n", " "))) == 0)
    return with_text(joined.where(~emptied), docs.columns, text, changed)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, any others) without the lines that are similar to an earlier one.

    A document that has no word left after that goes too; one that had none stays.  A NULL
    text stays NULL; an empty table gives an empty result.  Lines and texts of any length are compared whole.  Rows that are equal
    in doc_id and text are one document.  Other columns stay as they are, whatever their names.
    """
    return without_lines(docs, removed_lines(docs))
