"""Commits to a log: each write becomes visible whole, at once, and under a name of its own.

A commit is written below a hidden folder of the log and then moved to ``commit=<name>``.
Readers list only directories without a leading underscore, so they see finished
commits and nothing else.  A move never replaces or enters a folder that is there, so of several
writers of one name one succeeds.  A name that is there already is a finished commit: it is never
written again, so a batch that is run again after a failure changes nothing.

A commit that must not come twice claims its name first, for one draft: whoever finds the name claimed brings that
draft's publication to its end and throws its own away.  So an attempt that was killed anywhere, or that still runs when the next one
has begun, adds nothing.

A numbered commit becomes the next ledger of the log, ``commit=ledger-<n>``.  Its number is taken by the same
move that makes it visible, after everything is written: no clock is asked, numbers have no holes, and a
commit that is seen later has the higher one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

HIDDEN = "_unfinished"
CLAIMS = "_names"
NUMBERED = "ledger-"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def found(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a glob pattern matches, fetched as one text."""
    system, place = _file_system(spark, pattern)
    statuses = system.globStatus(place)
    return re.findall(r"\{path=([^;]*);", spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(statuses)) if statuses else []


def removed(spark: SparkSession, path: str) -> None:
    system, place = _file_system(spark, path)
    system.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def moved(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder in one step to a place where nothing is; False if something is there, or the source has gone."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    system, place = _file_system(spark, target)
    system.mkdirs(place.getParent())
    full = system.makeQualified(place)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(full.toUri(), conf)
    never_replace = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(system.makeQualified(jvm.org.apache.hadoop.fs.Path(source)), full, never_replace)
    except Exception:
        # whatever it was: either the move is needless, or it is an error
        if system.exists(place) or not exists(spark, source):
            return False
        raise
    return True


def _drafted(spark: SparkSession, path: str, name: str, write: Callable[[str], None]) -> tuple[str, str]:
    attempt = uuid.uuid4().hex
    draft = f"{path}/{HIDDEN}/{name}-{attempt}"
    try:
        write(draft)
    except BaseException:
        removed(spark, draft)
        raise
    system, source = _file_system(spark, draft)
    system.mkdirs(source)
    return draft, attempt


def commit(spark: SparkSession, path: str, name: str, write: Callable[[str], None]) -> bool:
    """Let ``write`` fill a folder and make it the commit ``name`` of the log at ``path``.

    False when that commit is there already; ``write`` is not called then.
    """
    path = path.rstrip("/")
    target = f"{path}/commit={name}"
    if exists(spark, target):
        return False
    draft, _ = _drafted(spark, path, name, write)
    if moved(spark, draft, target):
        return True
    removed(spark, draft)
    return False


def commit_once(
    spark: SparkSession,
    path: str,
    name: str,
    write: Callable[[str], None],
    *,
    floor: Callable[[], int] | None = None,
    before: Callable[[str], None] | None = None,
) -> bool:
    """Let ``write`` fill a folder and make it the commit ``name`` of the log at ``path``, or, if ``floor`` is given, its next
    ledger; once, whatever fails in between and whoever else tries.

    ``before`` is called with the folder of the draft that got the name, before that becomes visible and again if that did not
    happen.  ``floor`` is asked for the ledger before a log's first numbered commit.  False when the commit is there already, or is
    another attempt's.
    """
    path = path.rstrip("/")
    claim = f"{path}/{CLAIMS}/{name}"
    if floor is None and exists(spark, f"{path}/commit={name}"):
        return False
    winner, mine = recorded(spark, claim), None
    if winner is None:
        draft, mine = _drafted(spark, path, name, write)
        winner = recorded(spark, claim, mine)
        if winner != mine:
            removed(spark, draft)
    draft = f"{path}/{HIDDEN}/{name}-{winner}"
    # only this draft can get the name, and it is published when it is no longer there
    while exists(spark, draft):
        if before is not None:
            before(draft)
        target = name if floor is None else f"{NUMBERED}{last_ledger(spark, path, floor) + 1}"
        if moved(spark, draft, f"{path}/commit={target}"):
            break
    return winner == mine


def recorded(spark: SparkSession, place: str, value: str | None = None) -> str | None:
    """The value that was first recorded at ``place``, which is ``value`` if there was none; values are names of files."""
    system, folder = _file_system(spark, place)
    if value is not None and not system.exists(folder):
        ticket = f"{place.rpartition('/')[0]}/_{uuid.uuid4().hex}"
        _, inner = _file_system(spark, f"{ticket}/{value}")
        system.mkdirs(inner)
        if not moved(spark, ticket, place):
            removed(spark, ticket)
    if not system.exists(folder):
        return None
    return system.listStatus(folder)[0].getPath().getName()


def last_ledger(spark: SparkSession, path: str, floor: Callable[[], int] = lambda: 0) -> int:
    """The highest number of the numbered commits of a log, ``floor`` if it has none."""
    numbers = [int(p.rpartition("-")[2]) for p in found(spark, f"{path.rstrip('/')}/commit={NUMBERED}*")]
    return max(numbers, default=None) or floor()
