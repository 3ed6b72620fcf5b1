"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow that is served in proportion to its target. Its documents are
shuffled (by a digest of id and text) and get a virtual finish time: the source's words up
to and including the document, divided by the source's target. A second pass over the
source continues where the first one ends. All entries of all sources are then sorted by
finish time over the whole table, by a range split, and served in that order until the
total budget is used up.

Targets are shares by weight of the budget; a target stops at ``most`` times its source's
size, and what it leaves is shared again by weight until no target is above its limit.
Each round of this is one aggregation over the table of sources, which is a table like any
other (its positions come from a range split), so the number of sources may grow too.

A source may hold most of the rows: running sums are taken over range splits of
(source, digest), which cut a hot source into many tasks. Texts are read once, for sizes
and digests. Only built-in functions are used.

Defined results: a null text has no words; a null source is a source of its own, last in
order; documents without words are never taken, nor are those of a source without words;
rows equal in id, text and source are separate documents, of which the earlier finish
first; null ids are ids like others; an empty table gives an empty table; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondliq.llm.common import let_go, written
from bondliq.operators.cumulative import cumulative_within
from bondliq.operators.position import global_position

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
#: the budget as a share of all words, and how often a document may be repeated
SHARE, MOST = (3, 2), 2
WIDE = "decimal(38,0)"


def _digest():
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return F.md5(key.cast("binary"))


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, digest), one row per document."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    return docs.select("doc_id", "source", words.alias("size"), _digest().alias("digest"))


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """(source, flow, source_size, weight, target): ``flow`` numbers the sources in code-point
    order, null last, and weights repeat in that order."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = global_position(totals, [F.col("source").asc_nulls_last()], "flow")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("flow") - 1) % len(weights) + 1).cast("int"))
    flows = written(placed.select("source", "flow", "source_size", weight.cast("long").alias("weight")), "flows")
    limit, wide = F.col("source_size") * most, F.col("weight").cast(WIDE)
    everything = flows.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]

    def level(full):
        """Budget left for the sources that are not ``full``, times share[1], and their weight."""
        row = flows.agg(F.sum(F.when(full, limit).otherwise(0).cast(WIDE)).alias("words"), F.sum(F.when(~full, wide)).alias("weight"),
                        F.count(F.when(full, 1)).alias("n")).first()
        return share[0] * int(everything) - share[1] * int(row["words"] or 0), int(row["weight"] or 0), row["n"]

    full = F.lit(False)
    left, by, stopped = level(full)
    while by:
        full = limit.cast(WIDE) * F.lit(share[1] * by).cast(WIDE) < wide * F.lit(left).cast(WIDE)
        left, by, now = level(full)
        if now == stopped:
            break
        stopped = now
    even = (wide * F.lit(left).cast(WIDE)).cast("double") / F.lit(float(share[1] * max(by, 1)))
    return flows.select("*", F.when(full, limit.cast("double")).otherwise(even).alias("target"))


def _finish(turn):
    return F.try_divide((turn * F.col("source_size") + F.col("cum_size")).cast("double"), "target")


def served(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """The documents in line: doc_id, source, size, digest, flow, source_size, target, words
    of its source up to it ``cum_size``, and ``served``, the passes in which it is taken."""
    sized = written(sizes(docs), "sizes")
    flows = targets(sized, weights, share, most)
    kept = written(flows, "targets")
    joined = sized.join(kept.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "weight")
    line = written(cumulative_within(joined, ["flow"], ["digest", "doc_id"], ["size"]), "line")
    let_go(docs.sparkSession, sized)

    def place(turn):
        return F.struct(_finish(turn).alias("finish"), F.col("flow").alias("flow"), turn.cast("int").alias("turn"), F.col("digest").alias("digest"))

    entries = line.where("size > 0").select("size", F.explode(F.array(*[place(F.lit(i)) for i in range(most)])).alias("place"))
    queue = cumulative_within(entries, [], ["place"], ["size"], prefix="all_")
    budget = kept.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"] * share[0]
    last = queue.where(F.col("all_size") * share[1] <= budget).agg(F.max("place").alias("place")).first()["place"]
    if last is None:
        return line.withColumn("served", F.array().cast("array<int>"))
    end = F.struct(*[F.lit(last[f.name]).cast(f.dataType).alias(f.name) for f in entries.schema["place"].dataType])
    turns = F.filter(F.array(*[F.when(place(F.lit(i)) <= end, F.lit(i)) for i in range(most)]), lambda x: x.isNotNull())
    return line.withColumn("served", F.when(F.col("size") > 0, turns).otherwise(F.array().cast("array<int>")))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """Per document: doc_id, size, source_size, target (of its source), taken (words that
    the mix takes of it, repeats counted)."""
    out = served(docs, weights, share, most)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("served")).alias("taken"))


def mixture(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """The mix itself: finish, turn, doc_id, source, size, text, one row for each time that
    a document is taken; ``finish`` is the order in which the sources are served."""
    out = served(docs, weights, share, most)
    turn = F.explode("served").alias("turn")
    rows = out.select("digest", "doc_id", "source", "size", "source_size", "cum_size", "target", turn)
    texts = docs.select(_digest().alias("digest"), "text").dropDuplicates(["digest"])
    return rows.select(_finish(F.col("turn")).alias("finish"), "turn", "doc_id", "source", "size", "digest").join(
        texts, "digest").drop("digest")


def oracle(weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> str:
    """DuckDB SQL for ``mix`` over the view ``documents``."""
    case = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    turns = ", ".join(f"({i})" for i in range(most))
    return f"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))) AS digest FROM documents),
flows AS (SELECT source, row_number() OVER (ORDER BY source NULLS LAST) AS flow, sum(size) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (flow - 1) % {len(weights)} {case} END AS weight, {most} * source_size AS most_words,
    (SELECT sum(source_size) FROM flows) AS everything FROM flows),
ordered AS (SELECT *, row_number() OVER (ORDER BY most_words / weight, flow) AS k FROM weighed),
summed AS (SELECT *, coalesce(sum(most_words) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_before,
    sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left FROM ordered),
first_open AS (SELECT {share[0]} * everything - {share[1]} * words_before AS budget_left, weight_left, k FROM summed
    WHERE most_words * {share[1]} * weight_left >= weight * ({share[0]} * everything - {share[1]} * words_before) ORDER BY k LIMIT 1),
aims AS (SELECT s.*, CASE WHEN s.k < coalesce(f.k, s.k + 1) THEN CAST(most_words AS DOUBLE)
    ELSE CAST(weight * f.budget_left AS DOUBLE) / ({share[1]} * f.weight_left) END AS target FROM summed s LEFT JOIN first_open f ON true),
line AS (SELECT d.doc_id, d.size, d.digest, a.flow, a.source_size, a.target, a.everything,
    sum(d.size) OVER (PARTITION BY a.flow ORDER BY d.digest, d.doc_id ROWS UNBOUNDED PRECEDING) AS cum_size,
    row_number() OVER () AS row_no FROM sized d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source),
entries AS (SELECT l.*, turn, CAST(turn * source_size + cum_size AS DOUBLE) / target AS finish
    FROM line l, (VALUES {turns}) AS t(turn) WHERE size > 0),
queue AS (SELECT *, sum(size) OVER (ORDER BY finish, flow, turn, digest ROWS UNBOUNDED PRECEDING) AS all_size FROM entries),
taken AS (SELECT row_no, sum(size) AS words FROM queue WHERE {share[1]} * all_size <= {share[0]} * everything GROUP BY row_no)
SELECT l.doc_id, CAST(l.size AS BIGINT) AS size, CAST(l.source_size AS BIGINT) AS source_size, l.target,
    CAST(coalesce(t.words, 0) AS BIGINT) AS taken FROM line l LEFT JOIN taken t USING (row_no)"""
