"""The corpus pipeline, stage by stage, and the registered queries against SQL."""

import re
from collections import defaultdict

import pytest

import corpus_pipeline
from harness import compare
from quarry.llm.common import save
from quarry.llm.queries import ORACLE, QUERIES, TOKENIZERS
from test_operators import base_spans, exact, simhash_of, smallest


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    sql = ORACLE[name]
    ok, msg = compare(df, con, sql)
    assert ok, msg


def test_stages_keep_and_change_what_they_should(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = save(stage(spark, docs, sf_dir), f"test-{name}")  # as run() does; row ids need a written table
        kept.append((name, before, docs.columns))
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = [tuple(r) for r in docs.collect()]
        texts = {r[0]: r[1] for r in after}
        if name == "language_id":
            assert set(texts) == {i for i, t in before if t and re.search(r"[^\W\d_]", t)}
        elif name == "exact_dedup":
            assert set(texts) == {i for i, _, _, stays, _ in exact(before).values() if stays}
        elif name == "simhash_near_dedup":
            fp = {i: simhash_of(t) for i, t in before}
            links = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4]
            assert set(texts) == set(smallest(links, fp).values())
        elif name == "pii":
            assert set(texts) == {i for i, _ in before}
            for i, t in before:
                if not base_spans(t):
                    continue
                assert not base_spans(texts[i])
        else:
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(f"{TOKENIZERS}/word_bpe_49k.json")
            tokens = defaultdict(int)
            for r in docs.collect():
                tokens[r["doc_id"]] += r["length"]
            assert tokens == {i: len(t.encode(x or "", add_special_tokens=False).ids) + 1 for i, x in before}


def test_pipeline_on_nulls_repeats_and_nothing(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "the cat and the dog me@x.org", "en", None, 1),
            (2, "the cat and the dog me@x.org", "en", None, 1), (None, "der hund und die katze", "de", "s", 1), (5, "word " * 30_000, None, "s", 1)]
    for k, part in enumerate((rows, [])):
        spark.createDataFrame(part, schema).write.parquet(str(tmp_path / str(k) / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "0"))
    assert {r["doc_id"] for r in got.collect()} == {None, 2, 5}
    assert corpus_pipeline.run(spark, str(tmp_path / "1")).count() == 0


def test_only_the_entry_guards_the_import():
    import pathlib
    root = pathlib.Path(corpus_pipeline.__file__).parent
    for p in [root / "corpus_pipeline.py", *(root / "quarry/llm").glob("*.py")]:
        assert "ImportError" not in p.read_text()
    for p in (root / "quarry").rglob("*.py"):
        if "llm" not in p.parts:
            assert "quarry.llm" not in p.read_text()
