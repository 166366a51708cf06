"""The pipeline stage by stage against brute force, each on what its predecessor kept."""

import collections

import duckdb
import pytest
from test_corpus import WORDS, brute_components, table

import corpus_pipeline
from tidemark.llm import language, mixing, packing
from tidemark.llm.common import row_keyed
from tidemark.tables import materialize


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out.append(materialize(stage(spark, out[-1], sf_dir), f"test-{name}"))
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(tables):
    assert all(t.columns == tables[0].columns for t in tables)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "minhash_near_dedup", "mixing", "best_fit_packing"]


def test_language_stage(tables):
    model = language.fit(language.training_rows(tables[0]))
    want = sorted(i for i, t in pairs(tables[0]) if not language.decide(t, model)[2])
    assert sorted(i for i, _ in pairs(tables[1])) == want
    assert len(want) > 0.97 * tables[0].count()


def test_exact_stage(tables):
    groups = collections.defaultdict(list)
    for i, t in pairs(tables[1]):
        groups["".join(WORDS.findall(t or ""))].append((-len(t or ""), i))
    assert sorted(i for i, _ in pairs(tables[2])) == sorted(min(g)[1] for g in groups.values())


def test_near_stage(tables):
    found = brute_components(dict(pairs(tables[2])), 5, 80)
    assert sorted(i for i, _ in pairs(tables[3])) == sorted(i for i, (_, root) in found.items() if i == root)


def test_mixing_stage(tables):
    con = duckdb.connect()
    frame = tables[3].toPandas()  # noqa: F841
    con.execute("CREATE VIEW documents AS SELECT * FROM frame")
    want = {r[0]: r[4] // r[1] for r in con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.OP10_SQL})").fetchall() if r[4]}
    assert collections.Counter(i for i, _ in pairs(tables[4])) == want


def test_packing_stage(spark, sf_dir, tables):
    got = corpus_pipeline.run(spark, sf_dir).toPandas()
    encode = packing.tokenizer(*packing.vocabulary())
    assert got["length"].sum() == sum(len(encode(t)) + 1 for _, t in pairs(tables[4]))
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part["length"].sum() <= 2048 and list(part["offset"]) == [0, *part["length"].cumsum()[:-1]]
    assert got.sequence_id.nunique() <= -(-got["length"].sum() // 2048) + 2


def test_stages_take_empty_tables(spark, sf_dir, tables):
    docs = tables[0].limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"empty-{name}")
        assert docs.count() == 0


def test_stages_take_nulls_and_repeated_rows(spark, sf_dir):
    """A doc_id is no row: it may be null, come with one text twice or with several texts."""
    words = [f"word{i}" for i in range(120)]
    text, near, other = " ".join(words), " ".join([*words[:-1], "last"]), "One two three four five six."
    rows = [
        (1, other, "en", "a"), (1, other, "en", "a"), (1, other, "en", "a"), (2, other + " ", "en", "b"), (2, "A text that no other row has at all.", "en", "b"),
        (None, "An id is missing here.", "en", "b"), (None, "An id is missing  here.", "en", "b"), (None, "Another one without an id.", "en", None), (None, near, "en", "a"),
        (3, text, "en", "a"), (3, "Something else under this id.", "en", None), (4, text + " tail", "en", "b"), (5, None, None, None), (None, "", "en", "a"), (6, "####", "en", None),
    ]
    stages, docs = dict(corpus_pipeline.STAGES), table(spark, rows)
    key = lambda r: (r[0] is None, r[0] or 0)
    order = lambda rows: sorted(rows, key=str)

    model = language.fit(language.training_rows(docs))
    told = materialize(stages["language_id"](spark, docs, sf_dir), "odd-language")
    assert order(pairs(told)) == order((i, t) for i, t, *_ in rows if not language.decide(t, model)[2])

    for start in (docs, told):
        exact = materialize(stages["exact_dedup"](spark, start, sf_dir), "odd-exact")
        groups = collections.defaultdict(list)
        for i, t in pairs(start):
            groups["".join(WORDS.findall(t or ""))].append((i, t))
        assert order(pairs(exact)) == order(min(g, key=lambda r: (-len(r[1] or ""), key(r))) for g in groups.values())

    exact = materialize(stages["exact_dedup"](spark, docs, sf_dir), "odd-exact")
    near = materialize(stages["minhash_near_dedup"](spark, exact, sf_dir), "odd-near")
    had = sorted(pairs(exact), key=key)
    found = brute_components({n: t for n, (_, t) in enumerate(had)}, 5, 80)
    assert order(pairs(near)) == order(had[n] for n, (_, root) in found.items() if n == root)
    assert near.count() < exact.count() and near.filter("doc_id is null").count() >= 2

    mixed = materialize(mixing.mix(docs), "odd-mix")
    out = materialize(stages["mixing"](spark, docs, sf_dir), "odd-mixed")
    assert out.columns == docs.columns
    taken = [(r.doc_id, r.source, r.size) for r in mixed.collect() for _ in range(r.copies)]
    assert order(taken) == order((r.doc_id, r.source, len(WORDS.findall(r.text or ""))) for r in out.collect())
    assert any(i is None for i, *_ in taken)
    packed = stages["best_fit_packing"](spark, out, sf_dir).toPandas()
    assert (packed.piece == 0).sum() == out.count()


def test_row_keys_are_unique_and_stay(spark):
    docs = table(spark, [(i % 7 or None, "x", "en", "a") for i in range(100)])
    for keyed in (row_keyed(docs, "keys"), row_keyed(materialize(docs.repartition(5), "keys"), "keys")):
        first = [r._row for r in keyed.select("_row").collect()]
        assert len(set(first)) == 100 and sorted(first) == sorted(r._row for r in keyed.repartition(3).collect())
