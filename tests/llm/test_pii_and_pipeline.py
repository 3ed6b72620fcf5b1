"""op5 against plain regular expressions; the pipeline's stages."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bondliq.llm import pii
from bondliq.llm.common import table

#: the base patterns as the contract states them (fixed values)
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    double = lambda x: x * 2 - 9 if x > 4 else x * 2
    return sum(double(int(c)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def base(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def check(df, rows):
    got = {(r["doc_id"], r["base_sha256"]): r for r in df.collect()}
    for d, text in rows:
        spans = base(text or "")
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        r = got[d, digest]
        every = [x.split(":") for x in r["spans"].split(",") if x]
        assert {(k, int(a), int(b)) for k, a, b in every} >= set(spans)
        assert [r[f"n_{k}"] for k in BASE] == [sum(x[0] == k for x in every) for k in BASE]


def test_op5_random(spark):
    rng = random.Random(5)
    letters = "ab1234567890 .-+()@_%é\U0001f600\n"
    parts = ["a@b.c", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (499) 555-6503", "x", "12",
             "a@b.c+d@e.f", "a@b..c", "+", "é", "256.1.1.1.1.1", "a@b.c@d.e"]
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))) for i in range(600)]
    rows += [(600 + i, " ".join(rng.choice(parts) for _ in range(12))) for i in range(300)]
    rows += [(2000, None), (2001, ""), (2002, "1 " * 20_000), (2003, "a" * 3000), (2003, "a" * 3000)]
    check(pii.report(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_long_runs_take_linear_time(spark):
    rows = [(1, "a" * 300_000), (2, "a@" + "b." * 100_000), (3, "1" * 200_000), (4, "+1" + "(" * 200_000), (5, "1 " * 60_000)]
    assert pii.report(spark.createDataFrame(rows, "doc_id long, text string")).count() == 5


def test_bootstrapping_finds_unseen_identifiers(spark):
    seeds = [(i, f"words before call me at +1 (499) 555-{1000 + i} please and words after") for i in range(40)]
    unseen = [(100 + i, f"other text at 499x{i}5551 please more") for i in range(4)]
    plain = [(200 + i, f"there are {i} apples in box{i} today") for i in range(30)]
    rows = {r["doc_id"]: r for r in pii.report(spark.createDataFrame(seeds + unseen + plain, "doc_id long, text string")).collect()}
    assert all(rows[100 + i]["n_phone"] == 1 for i in range(4))
    assert all(rows[200 + i]["spans"] == "" for i in range(30))
    assert all(rows[i]["n_phone"] == 1 for i in range(40))


def test_masked(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd or +1 (499) 555-6503.", 7), (2, None, 8), (3, "x 12", 9), (4, "", 1)],
                                 "doc_id long, text string, size int")
    got = {r["doc_id"]: (r["text"], r["size"]) for r in pii.masked(docs).collect()}
    assert got == {1: ("mail <email> or <phone>.", 7), 2: (None, 8), 3: ("x 12", 9), 4: ("", 1)}


def test_op5_runs_no_python(spark, sf):
    plan = pii.report(table(spark, sf, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = table(spark, sf, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        from bondliq.llm.common import written

        out[name] = (docs, docs := written(stage(spark, docs, sf), f"test-{name}"))
    return out


def test_stages_keep_the_columns(stages):
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns
            assert 0 < after.count() <= before.count()


def test_near_dup_stage_keeps_one_of_each_group(spark, stages):
    before, after = stages["near_dup"]
    from tests.llm.test_near import roots_of, shingled

    sets = {r["doc_id"]: shingled(r["text"], 5) for r in before.collect()}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = roots_of(ids, links)
    assert sorted(r["doc_id"] for r in after.collect()) == [d for d in ids if root[d] == d]


def test_pii_stage_leaves_no_base_span(stages):
    before, after = stages["pii"]
    assert before.count() == after.count()
    for r in after.collect():
        assert not base(r["text"]) and r["n_chars"] == len(r["text"])


def test_packing_stage_covers_every_document(stages):
    before, after = stages["packing"]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()}


def test_pipeline_on_awkward_and_empty_tables(spark, sf, docs_of, awkward):
    for docs in (docs_of(awkward), docs_of(awkward).where("doc_id = 99")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name != "packing":
                assert out.columns == docs.columns
            docs = out
        docs.count()


def test_masking_text_in_stage_is_idempotent(spark):
    docs = spark.createDataFrame([(1, "see 10.0.0.1 and 10.0.0.1")], "doc_id long, text string")
    once = pii.masked(docs)
    assert [r["text"] for r in once.collect()] == ["see <ip> and <ip>"] == [r["text"] for r in pii.masked(once).collect()]


CLASHING = ["_id", "_text_key", "_no_id", "text_hash", "text_chars", "_cut", "_text", "_tie", "row", "key", "place", "kind", "base", "every"]


@pytest.mark.parametrize("stage", ["quality", "language", "near_dup", "pii"])
def test_stages_keep_clashing_columns(spark, sf, stage):
    """Columns that bear the names used inside, as strings, come back as they were."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    clash = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in CLASHING})
    run = dict(corpus_pipeline.STAGES)[stage]
    got = run(spark, clash, sf).select("doc_id", *CLASHING).collect()
    assert got and all(r[c] == f"{c} of {r['doc_id']}" for r in got for c in CLASHING)
    plain = run(spark, docs, sf)
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in plain.select("doc_id").collect())


def test_a_value_that_seeds_two_kinds_is_a_seed_of_both(spark):
    from bondliq.llm import pii

    def row(i, kind, value, left):
        return (i, 10, kind, 0, 5, value, left, "")

    # one value stands as a card and as a phone number; each kind has five seeds with it
    rows = [row(i, "card", f"c{i}", "cardno") for i in range(4)] + [row(9, "card", "both", "cardno")]
    rows += [row(20 + i, "phone", f"p{i}", "callme") for i in range(4)] + [row(29, "phone", "both", "callme")]
    rows += [row(40, "slot", "new1", "cardno"), row(41, "slot", "new2", "callme")]
    spans = spark.createDataFrame(rows, "text_hash long, text_chars int, kind string, start int, stop int, value string, left string, right string")
    found = {(r["text_hash"], r["kind"]) for r in pii.bootstrap(spans, accept=0.3).collect()}
    assert found == {(40, "card"), (41, "phone")}
