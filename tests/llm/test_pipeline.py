"""The pipeline's stages against what each should leave, and the queries."""

import brute
import corpus_pipeline as c
import pytest
from lexicount.llm import bagminhash, langid, queries, secret_scan
from lexicount.llm._spark import written


@pytest.fixture(scope="module")
def stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    out = [docs]
    for _, stage in c.STAGES:
        out.append(written(stage(spark, out[-1], data), "test-stage"))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stage_names_and_columns(stages):
    assert [n for n, _ in c.STAGES] == ["quality_rules", "language_id", "near_dedup", "secret_scans", "best_fit_packing"]
    for df in stages[:-1]:
        assert df.schema == stages[0].schema


def test_quality_rules(stages):
    before = [(r.doc_id, r.source, r.text) for r in stages[0].collect()]
    want = brute.quality(before, 20, 0.002, 0.2)
    assert {i: r.text for i, r in rows(stages[1]).items()} == {i: want[h, t][-1] for i, h, t in before if want[h, t][-2]}


def test_language_id(spark, stages):
    docs, left = stages[1], rows(stages[2])
    judged = langid.predicted(docs, langid.learned(docs)).collect()
    assert set(left) == {r.doc_id for r in judged if not r.rejected}
    assert all(left[i] == r for i, r in rows(docs).items() if i in left)


def test_near_dedup(stages):
    before = stages[2].select("doc_id", "text").collect()
    least = {}
    for r, k in zip(before, brute.classes([r.text for r in before])):
        least[k] = min(r.doc_id, least.get(k, r.doc_id))
    assert set(rows(stages[3])) == set(least.values())


def test_secret_scans(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    changed = [i for i in before if before[i].text != after[i].text]
    assert changed and all(after[i].n_chars == len(after[i].text) for i in changed)
    assert all(brute.base_spans(before[i].text) for i in changed)


def test_secret_scans_mask_every_live_span(stages):
    """What is left of a text: its pieces between the live spans, no value of one."""
    before, after = rows(stages[3]), rows(stages[4])
    n = 0
    for r in secret_scan.scanned(stages[3]).collect():
        text, out, at = before[r.doc_id].text, "", 0
        for x in r.spans:
            if x.live:
                n += 1
                if x.start >= at:
                    out += text[at : x.start] + "[secret]"
                at = max(at, x.end)
        assert after[r.doc_id].text == out + text[at:]
    assert n > 0


def test_packing_holds_every_document(stages):
    packed = stages[5].collect()
    assert {r.doc_id for r in packed} == set(rows(stages[4]))
    assert max(r.offset + r.length for r in packed) <= 2048


def test_run_is_its_stages(spark, data, stages):
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(c.run(spark, data)) == key(stages[5])


@pytest.mark.parametrize("n", range(5))
def test_stages_take_awkward_rows(spark, data, awkward, empty, n):
    """The columns of documents with clashing ones beside them."""
    _, stage = c.STAGES[n]
    got = stage(spark, awkward, data)
    if n < 4:
        assert got.columns == awkward.columns
    assert got.count() > 0
    assert stage(spark, empty, data).count() == 0


def test_every_operator_is_registered():
    names = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op"))
    assert names == list(range(1, 14)) and "pipeline" in queries.QUERIES and c.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, data, name):
    from tools.oracle_check import duck, rows_of

    df = queries.QUERIES[name](spark, data)
    rel = duck(data).sql(queries.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    mine = [tuple(r[c] for c in order) for r in df.collect()]
    other = [tuple(r[rel.columns.index(c)] for c in order) for r in rel.fetchall()]
    assert rows_of(order, mine) == rows_of(order, other)


def test_labels_cut_by_the_documents_only(spark, data):
    """Near duplicates: the class of a document does not follow the row order."""
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(300)
    a, b = (sorted((r.doc_id, r.class_id) for r in bagminhash.classes(d).collect()) for d in (docs, docs.repartition(9)))
    assert a == b
