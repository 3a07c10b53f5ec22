"""The pipeline stage by stage against what each stage's decisions must be."""

from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline as P
from millrace.llm import attention
from millrace.llm.buckets import pack_buckets
from millrace.llm.common import stored, table
from millrace.settings import work_folder
from tests.conftest import SF
from tests.llm.test_fragment_join import brute
from tests.llm.test_placing import words
from tests.llm.test_sanitise import plain_spans


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    assert [n for n, _ in P.STAGES] == [
        "quality", "near_duplicates", "personal_data", "source_mix", "packing"]
    steps = [docs]
    for name, stage in P.STAGES:
        steps.append(stored(stage(spark, steps[-1], SF), name))
        assert name == "packing" or steps[-1].columns == columns
    all_, good, single, clean, mixed, packed = ([r for r in s.collect()] for s in steps)

    model = attention.fit(docs, table(spark, SF, "labels"))
    want = {r.doc_id for r in attention.score(docs, model).where("score >= 0.3").collect()}
    assert {r.doc_id for r in good} == want and len(good) == len(want)
    bad = {r.doc_id for r in table(spark, SF, "labels").where("quality = 0").collect()}
    assert len(bad & want) <= 0.1 * len(bad) + 1

    groups = brute([(r.doc_id, r.text) for r in good], 5, 4, 5)
    assert {r.doc_id for r in single} == {i for i, (_, c) in groups.items() if i == c}

    before = {r.doc_id: r.text for r in single}
    assert {r.doc_id for r in clean} == set(before)
    for r in clean:
        if plain_spans(before[r.doc_id]):
            assert not plain_spans(r.text) and r.n_chars == len(r.text)
        else:
            assert r.text == before[r.doc_id]

    sizes = {r.doc_id: words(r.text) for r in clean}
    times = Counter(r.doc_id for r in mixed)
    assert max(times.values()) <= 3 and set(times) <= set(sizes)
    assert abs(sum(sizes[i] * n for i, n in times.items()) - sum(sizes.values())) < max(
        sizes.values())
    length = Counter()
    for r in packed:
        length[r.doc_id] += r.length
    assert length == Counter({i: sizes[i] * n for i, n in times.items()})


def test_pipeline_on_nothing(spark):
    docs = table(spark, SF, "documents").where("false")
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_registered():
    names = set(__spark_entry__.queries())
    assert {"pipeline"} | {n for n in names if n.startswith("op")} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert set(__spark_entry__.oracle_sql()) <= names


def test_bucket_tokens_can_be_given(spark):
    docs = table(spark, SF, "documents")
    got = pack_buckets(docs, F.col("n_chars"), longest=100_000, buckets=3)
    assert got.agg(F.sum("length")).first()[0] == docs.agg(F.sum("n_chars")).first()[0]


def test_mixed_repeats_rows_by_their_own_share(spark):
    """As often in all as the mix takes them, with repeated rows, null ids and clashing columns."""
    from millrace.llm.fair_mix import mix, mixed
    from tests.llm.cases import documents, frame
    rows = documents()
    rows += [rows[9]] * 4 + [(None, "no id", None, "s1", 5, None), (None, "no id two", None, "s1", 5, None),
                             (None, None, None, "s1", 5, None), (6, "other text", "x", "s2", 3, None)]
    df = frame(spark, rows)
    names = ["_d", "_t", "_s", "_times", "_rows", "_own", "_again", "_id", "_all", "_text"]
    df = df.select("*", *[F.lit(x).alias(x) for x in names])
    out = mixed(df)
    assert out.columns == df.columns
    got = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in out.collect())
    want = Counter()
    for r in mix(df).collect():
        if r.times:
            want[r.doc_id, r.source, r.size] += r.times
    assert got == want and max(Counter(rows[9][:1] * 5).values()) == 5


def test_stages_leave_little_behind(spark):
    """Work tables of a stage go before it returns; what is left is one table of ids."""
    folder = Path(work_folder(spark))
    folder.mkdir(parents=True, exist_ok=True)
    docs = table(spark, SF, "documents")
    for name, stage in P.STAGES[:4]:
        before = set(folder.iterdir())
        stage(spark, docs, SF)
        left = set(folder.iterdir()) - before
        assert len(left) == 1, (name, left)
