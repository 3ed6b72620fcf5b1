"""Personal data by fixed patterns and bootstrapped contextual extraction.

Base: four kinds are found by regular expressions and checks (e-mail, IP address, card
number, phone number). They are the seeds, each a whole match. A candidate is a
longest run of identifier-like words (with a digit or an at sign) that touch no base span
and are joined by single spaces. Both are slots with a context: the words left and right
of the words that they touch. Contexts of seeds are the patterns; a pattern of a kind
links all slots that stand in its context.

Scores run over this graph for a few rounds: a pattern's score is the mean score of its
slots, damped by the number of different seeds behind it; a slot's score is the highest
of its patterns' scores (seeds keep 1). Slots outside the base whose score for a kind
reaches ``accept``, through patterns with enough different seeds, become spans of that
kind. Base spans always stay. All of it is DataFrame operations: aggregations that
combine before the shuffle, and joins of small rows.

Matching never backtracks over a repetition (possessive quantifiers, starts only at the
beginning of a run), so long texts take linear time. Positions come from the pieces
between the matches; offsets count code points, end exclusive.

Defined results: null text is the empty text and has no spans; repeated rows are
scanned one by one; documents with the same id share nothing but the id; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondliq.llm.common import written

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, written so that a match starts at the beginning of a run and
#: repetitions never give back; what they match is what the plain forms match.
_LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: texts without these hold no match of the kind, so they skip its regular expression
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
_WS = r"\x20\x09-\x0D"
#: an identifier-like word, and the words next to it in the text before and after
SLOT = rf"(?<![^{_WS}])[^{_WS}0-9@]*+[0-9@][^{_WS}]*+"
LAST_WORD = rf"(?<![^{_WS}])([^{_WS}]++)[{_WS}]*+$"
FIRST_WORD = rf"^[{_WS}]*+([^{_WS}]++)"
#: texts without any of these hold no span of any kind
ANY = "[0-9@]"
KEY = ("text_hash", "text_chars")


def keyed(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with a key of the text; equal texts have equal spans and share it."""
    return df.withColumns({KEY[0]: F.xxhash64(text), KEY[1]: F.length(text)})


def matches(text: Column, kind: str, pattern: str) -> Column:
    """All leftmost non-overlapping matches in order: kind, place in that order, length
    of the text since the match before (lead), own length, value, words around it, and
    whether a single space is all that lies between it and the match before."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    columns = [found.alias("m"), pieces.alias("before")]
    if kind == "slot":
        rest = 1_000_000_000
        columns += [F.slice(pieces, 2, rest).alias("after"), F.concat(F.array(F.lit("")), found).alias("previous"),
                    F.slice(found, 2, rest).alias("following")]

    # everything an element needs is zipped to it, so arrays are made once a text
    def one(x: Column, i: Column) -> Column:
        left = right = F.lit("")
        if kind == "slot":
            left = F.coalesce(F.nullif(F.regexp_extract(x["before"], LAST_WORD, 1), F.lit("")), x["previous"], F.lit(""))
            right = F.coalesce(F.nullif(F.regexp_extract(x["after"], FIRST_WORD, 1), F.lit("")), x["following"], F.lit(""))
        return F.struct(F.lit(kind).alias("kind"), i.alias("place"), F.length(x["before"]).alias("lead"),
                        F.length(x["m"]).alias("size"), x["m"].alias("value"), F.lower(left).alias("left"), F.lower(right).alias("right"),
                        (x["before"] == " ").alias("joined"))

    return F.filter(F.transform(F.arrays_zip(*columns), one), lambda x: x["value"].isNotNull())


def luhn(digits: Column) -> Column:
    """Does the decimal string pass the Luhn check?"""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, 1).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def located(docs: DataFrame, text: str = "text") -> DataFrame:
    """Base spans and candidates of all distinct texts: the key, kind (``slot`` for
    candidates), start, stop, value, left, right."""
    some = keyed(docs.where(F.col(text).rlike(ANY)).select(F.col(text).alias("_text")), "_text")
    none = matches(F.lit(""), "none", "x")
    kinds = [F.when(F.col("_text").rlike(NEEDS[k]), matches(F.col("_text"), k, PATTERNS[k])).otherwise(none) for k in KINDS]
    rows = some.select(*KEY, F.explode(F.concat(*kinds, matches(F.col("_text"), "slot", SLOT))).alias("m")).select(*KEY, "m.*")
    rows = rows.distinct()  # copies of a text are folded before they are dealt out
    so_far = Window.partitionBy(*KEY, "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("stop", F.sum(F.col("lead") + F.col("size")).over(so_far).cast("int"))
    rows = rows.withColumn("start", F.col("stop") - F.col("size"))
    ok = F.lit(True)
    for k in KINDS:
        ok = F.when(F.col("kind") == k, valid(k, F.col("value"))).otherwise(ok)
    rows = rows.where(ok)
    is_slot = F.col("kind") == "slot"

    def along(slots: Column, spans: Column):
        """All rows of a text up to this one, ordered by these positions."""
        return Window.partitionBy(*KEY).orderBy(F.when(is_slot, slots).otherwise(spans)).rowsBetween(Window.unboundedPreceding, 0)

    start, stop = F.col("start"), F.col("stop")
    # an identifier-like word touches a span if the last span that starts before its end ends after its start
    touched = F.max(F.when(~is_slot, stop)).over(along(2 * stop - 1, 2 * start)) > start
    # a span's first and last characters lie in identifier-like words, whose neighbours are its context
    left = F.last(F.when(is_slot, F.col("left")), ignorenulls=True).over(along(2 * start, 2 * start + 1))
    right = F.last(F.when(is_slot, F.col("right")), ignorenulls=True).over(along(2 * start, 2 * stop - 1))
    rows = rows.withColumns({"touched": F.coalesce(touched, F.lit(False)), "_left": left, "_right": right})
    columns = [*KEY, "kind", "start", "stop", "value", "left", "right"]
    base = rows.where(~is_slot).withColumns({"left": F.col("_left"), "right": F.col("_right")}).select(*columns)
    # runs of words that touch no span
    by_place = Window.partitionBy(*KEY).orderBy("place")
    follows = F.col("joined") & ~F.lag("touched", 1, True).over(by_place)
    runs = rows.where(is_slot).withColumn("begins", F.when(follows, 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("begins").over(by_place.rowsBetween(Window.unboundedPreceding, 0))).where("not touched")
    words = F.array_sort(F.collect_list(F.struct("place", "value")))
    runs = runs.groupBy(*KEY, "run").agg(
        F.lit("slot").alias("kind"), F.min("start").alias("start"), F.max("stop").alias("stop"), F.array_join(words["value"], " ").alias("value"),
        F.min_by("left", "place").alias("left"), F.max_by("right", "place").alias("right"))
    return base.unionByName(runs.select(*columns))


def bootstrap(spans: DataFrame, rounds: int = 3, min_seeds: int = 5, accept: float = 0.8) -> DataFrame:
    """Spans that the base lacks: the key, kind, start, stop. Iterates on written tables."""
    rows = spans.select(*KEY, "start", "stop", "left", "right", F.when(F.col("kind") != "slot", F.col("kind")).alias("kind"),
                        F.xxhash64("value").alias("slot"))
    near = rows.select("slot", "kind", F.explode(F.array(
        F.struct(F.lit("L").alias("side"), F.col("left").alias("word")),
        F.struct(F.lit("R").alias("side"), F.col("right").alias("word")))).alias("c")).where("c.word <> ''")
    # the pattern-instance graph: how often a value stands in a context
    graph = written(near.groupBy(F.xxhash64("c.side", "c.word").alias("pattern"), "slot").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_set("kind")).alias("kinds")), "pii-graph")  # a value may seed several kinds
    seeded = graph.select("pattern", F.explode("kinds").alias("kind")).groupBy("pattern", "kind").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= min_seeds)
    seeded = written(seeded, "pii-patterns")
    # only contexts of seeds matter from here on
    graph = written(graph.join(seeded.select("pattern", F.col("kind").alias("as_kind"), "seeds"), "pattern"), "pii-edges")
    seed = F.when(F.array_contains("kinds", F.col("as_kind")), 1.0).when(F.size("kinds") > 0, 0.0)
    scored = graph.select("*", F.coalesce(seed, F.lit(0.0)).alias("score"))
    patterns = None
    for _ in range(rounds):
        patterns = written(scored.groupBy("pattern", "as_kind").agg(
            (F.sum(F.col("score") * F.col("n")) / F.sum("n") * (1 - 1 / (1 + F.max("seeds")))).alias("trust")), "pii-trust")
        values = graph.join(patterns, ["pattern", "as_kind"]).where("size(kinds) = 0").groupBy("slot", "as_kind").agg(F.max("trust").alias("found"))
        scored = graph.join(values, ["slot", "as_kind"], "left").select(
            *graph.columns, F.coalesce(seed, F.col("found"), F.lit(0.0)).alias("score"))
    trusted = patterns.where(F.col("trust") >= accept).select("pattern", F.col("as_kind").alias("new_kind"), "trust")
    new = rows.where("kind is null").select(*KEY, "start", "stop", F.explode(F.array(
        F.xxhash64(F.lit("L"), "left"), F.xxhash64(F.lit("R"), "right"))).alias("pattern")).join(trusted, "pattern")
    best = new.groupBy(*KEY, "start", "stop").agg(F.max_by("new_kind", F.struct("trust", "new_kind")).alias("kind"))
    return best.select(*KEY, "kind", "start", "stop")


def find(docs: DataFrame, text: str = "text", **settings) -> DataFrame:
    """One row per distinct text that has spans: the key, ``base`` and ``every``, arrays
    of (kind number in ``KINDS``, start, stop) in this order."""
    spans = written(located(docs, text), "pii-spans")
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    base = spans.where("kind <> 'slot'").select(*KEY, number.alias("kind"), "start", "stop", F.lit(True).alias("is_base"))
    more = bootstrap(spans, **settings).select(*KEY, number.alias("kind"), "start", "stop", F.lit(False).alias("is_base"))
    span = F.struct("kind", "start", "stop")
    return base.unionByName(more).groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.when(F.col("is_base"), span))).alias("base"),
        F.array_sort(F.collect_list(span)).alias("every"))


def report(docs: DataFrame, **settings) -> DataFrame:
    """Per row: doc_id, counts of all spans by kind, base_sha256, spans."""
    found = find(docs, **settings)
    rows = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))).select("doc_id", *KEY)
    names = F.array(*map(F.lit, KINDS))

    def listed(spans: str) -> Column:
        every = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"]), s["start"], s["stop"]))
        return F.coalesce(F.array_join(every, ","), F.lit(""))

    def count(kind: int) -> Column:
        return F.coalesce(F.size(F.filter("every", lambda s: s["kind"] == kind)), F.lit(0)).cast("long")

    return rows.join(found, list(KEY), "left").select(
        "doc_id", *[F.when(F.col("every").isNotNull(), count(i)).otherwise(F.lit(0)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS, 1)],
        F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("every").alias("spans"))


def masked(docs: DataFrame, text: str = "text", **settings) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets. Spans that
    overlap are replaced together, under the first one's kind. Null texts stay null."""
    # the caller's columns travel in one, so that no name clashes with those made here
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    found = find(packed, "text", **settings)
    body, names = F.col("text"), F.array(*map(F.lit, KINDS))
    by_start = F.array_sort(F.transform("every", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    # each span, and the end of those before it: pieces of text between spans are cut once
    ends = F.aggregate(by_start, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,start:int,kind:int>>").alias("cuts")),
                       lambda acc, s: F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.when(
                           s["start"] >= acc["at"], F.array_append(acc["cuts"], F.struct(acc["at"].alias("at"), s["start"].alias("start"), s["kind"].alias("kind"))))
                           .otherwise(acc["cuts"]).alias("cuts")))
    hit = keyed(packed.where(body.rlike(ANY))).join(found.select(*KEY, ends.alias("_cut")), list(KEY), "left")
    piece = F.transform("_cut.cuts", lambda c: F.concat(
        F.substring(body, c["at"] + 1, c["start"] - c["at"]), F.lit("<"), F.element_at(names, c["kind"]), F.lit(">")))
    clean = F.when(F.col("_cut").isNotNull(), F.concat(F.array_join(piece, ""), F.substring(body, F.col("_cut.at") + 1, F.length(body)))).otherwise(body)
    rest = packed.where(~F.coalesce(body.rlike(ANY), F.lit(False))).select("row.*")
    return hit.select(*[clean.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns]).unionByName(rest)
