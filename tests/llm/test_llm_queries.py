"""The registered queries, and the pipeline against brute force."""

import collections
import hashlib
import pathlib

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from pageloom.llm import decontam, queries, toxicity
from test_llm_near import brute_components, brute_print
from test_llm_near import _groups as exact_groups


def test_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "decontamination", "bpe_encoding"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in pathlib.Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = collections.Counter(tuple(r) for r in df.select(columns).collect())
    assert rows == collections.Counter(con.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall())


def test_shard_query(spark, sf_dir):
    got = queries.op8_token_shards(spark, sf_dir)
    assert got.count() > 0 and got.where("NOT verified").count() == 0


def test_pipeline(spark, sf_dir, documents, texts):
    model = toxicity.fit_on(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(documents, model).collect() if r.predicted}
    left = {i: t for i, t in texts.items() if i not in toxic}
    left = {min(ids): left[min(ids)] for ids in exact_groups(left.items()).values()}
    prints = {i: brute_print(t) for i, t in left.items()}
    root, first = brute_components(prints.values()), {}
    for i in sorted(left):
        first.setdefault(root[prints[i]], i)
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    index = decontam.ItemIndex([(r.item_id, r.text) for r in bench], 5, 0.8, decontam.RADIUS, True)
    kept = sorted(first.values())
    leaks = {kept[row] for row, *_ in index.matches([left[i] for i in kept])}
    library = Tokenizer.from_file(queries.TOKENIZERS + "word_bpe_49k.json")
    wanted = {i: library.encode(left[i], add_special_tokens=False).ids for i in kept if i not in leaks}
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id: list(r.ids) for r in got} == wanted
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_stages_keep_the_columns(spark, sf_dir, odd, none):
    for docs in (odd, none.withColumns({"lang": none.text, "n_chars": none.doc_id})):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, sf_dir)
            assert kept.columns == docs.columns and kept.count() <= docs.count()
        assert corpus_pipeline.encode(spark, docs, sf_dir).count() == docs.count()


def test_columns_named_like_internal_ones(spark, sf_dir, documents):
    """Stages pass columns on as they are, also those that have the names of columns of their own."""
    docs = documents.where("doc_id < 60").selectExpr("*", "int(doc_id) AS _row", "concat('r', doc_id) AS _repeat", "doc_id AS key", "'s' AS sha", "doc_id AS bucket", "'b' AS print", "1 AS Root", "doc_id AS held_out")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.schema.simpleString() == docs.schema.simpleString()
        assert kept.where("_row <> doc_id OR _repeat <> concat('r', doc_id) OR key <> doc_id OR print <> 'b'").count() == 0 < kept.count()


def test_last_stage_decodes(spark, sf_dir, documents, texts):
    library = Tokenizer.from_file(queries.TOKENIZERS + "word_bpe_49k.json")
    got = corpus_pipeline.encode(spark, documents, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.decoded_sha256 == hashlib.sha256(library.decode(list(r.ids), skip_special_tokens=False).encode()).hexdigest()
