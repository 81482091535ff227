"""Line deduplication by winnowing over line hashes (operator 5), native Spark only.

A run is consecutive lines of one document, blank lines left out, of ``min_words`` words
or more together. A line is deleted if it lies in a run that occurred before, in an
earlier document by ``doc_id`` or further up in its own. What is deleted is the same as
by comparing all runs:

* Each line begins and ends a shortest run, a window of at most ``min_words`` lines; every
  repeated run is made up of repeated windows.
* The smallest line hash of a window is its fingerprint. Equal windows have equal
  fingerprints, so a fingerprint at a single place rules its windows out. Most of the
  text goes here, by an aggregate over the selected positions.
* Around the repeated positions matches are extended up and down to whole windows, and
  windows are compared by their content: the first place of each is found by an
  aggregate, never by pairs of places, so a line that a third of all documents share is
  no heavy group. All later places are deleted.

Defined cases: a null text stays null; an empty text stays empty; a document that loses
all its lines has the empty text. Blank lines stay as they are. A null ``doc_id`` comes
before all others. Rows with equal ``doc_id`` are ordered by a hash of their text;
rows equal in both are one document and all get its result. All columns are kept; the
counts ``n_lines`` and ``n_removed`` get underscores in front if their names are taken.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.common import fresh, stored

MIN_WORDS = 4
WORD = r"[^ \t\r\f\x0B]+"


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs cut from ``text``, and ``n_lines``, ``n_removed``."""
    windows = stored(_windows(docs, min_words), "line-windows")
    return _rewritten(docs, _repeats(windows))


def _text_key(text: Column) -> Column:
    return F.xxhash64(text, F.lit(5))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _windows(docs: DataFrame, min_words: int) -> DataFrame:
    """Shortest runs: place, lines, fingerprint with its place, hash of the content."""
    line = F.transform(
        _lines(F.col("text")),
        lambda text, at: F.struct(
            at.alias("at"),
            F.regexp_count(text, F.lit(WORD)).alias("words"),
            F.xxhash64(text).alias("h"),
            F.xxhash64(text, F.lit(1)).alias("h2"),
        ),
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("words"))

    def length(lines: Column) -> Column:
        """Lines from the start of ``lines`` until the words suffice, else null."""
        return F.aggregate(
            lines,
            start,
            lambda acc, x: F.when(acc["words"] >= min_words, acc).otherwise(
                F.struct((acc["n"] + 1).alias("n"), (acc["words"] + x["words"]).alias("words"))
            ),
            lambda acc: F.when(acc["words"] >= min_words, acc["n"]),
        )

    lines = F.col("lines")
    place = F.sequence(F.lit(1), F.size(lines))
    down = F.transform(
        place, lambda k: F.struct(k.alias("first"), length(F.slice(lines, k, F.lit(min_words))).alias("n"))
    )
    reach = F.lit(min_words)
    up = F.transform(
        place,
        lambda k: F.struct(
            k.alias("last"),
            length(
                F.reverse(F.slice(lines, F.greatest(F.lit(1), k - reach + 1), F.least(k, reach)))
            ).alias("n"),
        ),
    )
    up = F.transform(up, lambda w: F.struct((w["last"] - w["n"] + 1).alias("first"), w["n"].alias("n")))
    spans = F.array_distinct(
        F.filter(F.concat(down, up), lambda w: w["n"].isNotNull())
    )
    shown = F.transform(spans, lambda w: F.slice(lines, w["first"], w["n"]))
    return (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            _text_key(F.col("text")).alias("text_key"),
            F.filter(line, lambda x: x["words"] > 0).alias("lines"),
        )
        .where(F.size("lines") > 0)
        .select("doc_id", "text_key", F.explode(shown).alias("run"))
        .select(
            "doc_id",
            "text_key",
            F.array_min(F.transform("run", lambda x: F.struct(x["h"], -x["at"]))).alias("least"),
            F.col("run.at").alias("at"),
            F.xxhash64("run.h").alias("content"),
            F.xxhash64("run.h2").alias("content2"),
        )
        .select(
            "doc_id",
            "text_key",
            F.col("least").getField("h").alias("fingerprint"),
            F.xxhash64("doc_id", "text_key", F.col("least").getField("col2")).alias("place"),
            "at",
            "content",
            "content2",
        )
    )


def _repeats(windows: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key`` and the lines to delete."""
    repeated = (
        windows.groupBy("fingerprint")
        .agg(F.min("place").alias("a"), F.max("place").alias("b"))
        .where("a <> b")
        .select("fingerprint")
    )
    candidates = windows.join(repeated, "fingerprint", "left_semi")
    where = F.struct("doc_id", "text_key", F.col("at")[0].alias("line"))
    firsts = candidates.groupBy("content", "content2").agg(
        F.min(where).alias("first"), F.max(where).alias("last")
    )
    firsts = firsts.where(~F.col("first").eqNullSafe(F.col("last"))).drop("last")
    return (
        candidates.join(firsts, ["content", "content2"])
        .where(~where.eqNullSafe(F.col("first")))
        .select("doc_id", "text_key", F.explode("at").alias("line"))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("line").alias("lines"))
    )


def _rewritten(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    id_name, key_name, cut_name = (fresh(docs, f"_cut_{part}") for part in ("id", "key", "lines"))
    cuts = repeats.select(
        F.col("doc_id").alias(id_name), F.col("text_key").alias(key_name), F.col("lines").alias(cut_name)
    )
    joined = docs.join(
        cuts,
        F.col("doc_id").cast("long").eqNullSafe(F.col(id_name))
        & (_text_key(F.col("text")) == F.col(key_name)),
        "left",
    )
    lines = _lines(F.col("text"))
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.transform(
        F.array_except(numbers, F.col(cut_name)), lambda at: F.element_at(lines, at + 1)
    )
    left = F.filter(kept, lambda line: F.regexp_count(line, F.lit(WORD)) > 0)
    text = F.when(F.col(cut_name).isNull(), F.col("text")).otherwise(
        F.when(F.size(left) > 0, F.array_join(kept, "\n")).otherwise(F.lit(""))
    )
    n_lines = F.size(F.filter(lines, lambda line: F.regexp_count(line, F.lit(WORD)) > 0))
    return joined.select(
        *(text.alias(c) if c == "text" else F.col(c) for c in docs.columns),
        n_lines.cast("long").alias(fresh(docs, "n_lines")),
        F.coalesce(F.size(cut_name), F.lit(0)).cast("long").alias(fresh(docs, "n_removed")),
    )


ORACLE = f"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
counted AS (
  SELECT *, len(regexp_extract_all(line, '[^ \\t\\r\\f\\x0B]+')) AS w FROM split),
n AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k,
         sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS upto
  FROM counted WHERE w > 0),
runs AS (
  SELECT a.doc_id, a.k AS s, b.k AS e, b.upto - a.upto + a.w AS words,
         b.upto - b.w - a.upto + a.w AS less_last, b.upto - a.upto AS less_first
  FROM n a JOIN n b ON a.doc_id = b.doc_id AND b.k BETWEEN a.k AND a.k + {MIN_WORDS - 1}),
shortest AS (
  SELECT doc_id, s, e FROM runs
  WHERE words >= {MIN_WORDS} AND (less_last < {MIN_WORDS} OR less_first < {MIN_WORDS})),
spelled AS (
  SELECT r.doc_id, r.s, r.e, string_agg(n.line, chr(10) ORDER BY n.k) AS content
  FROM shortest r JOIN n ON n.doc_id = r.doc_id AND n.k BETWEEN r.s AND r.e
  GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, s) AS nth FROM spelled),
gone AS (
  SELECT DISTINCT n.doc_id, n.i FROM ranked r
  JOIN n ON n.doc_id = r.doc_id AND n.k BETWEEN r.s AND r.e WHERE r.nth > 1),
marked AS (
  SELECT c.*, g.i IS NOT NULL AS cut FROM counted c LEFT JOIN gone g USING (doc_id, i)),
rebuilt AS (
  SELECT doc_id, count(*) FILTER (w > 0) AS n_lines, count(*) FILTER (cut) AS n_removed,
         count(*) FILTER (w > 0 AND NOT cut) AS n_left,
         string_agg(line, chr(10) ORDER BY i) FILTER (NOT cut) AS kept
  FROM marked GROUP BY doc_id)
SELECT doc_id, n_lines, n_removed,
       CASE WHEN n_removed = 0 THEN text WHEN n_left > 0 THEN kept ELSE '' END AS text
FROM documents JOIN rebuilt USING (doc_id)
"""
