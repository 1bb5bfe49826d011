"""The pipeline against a brute-force run of its stages; entry registration."""

import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from citybeat.llm import line_crf, secrets
from tests.llm.test_content_sort import SPACE
from tests.llm.test_line_crf import base
from tests.llm.test_signature_join import brute as near

SF = "/root/testdata/sf0.01"


def test_stages_and_result(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, source, lang FROM '{SF}/documents.parquet'").fetchall()
    table = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")}
    field = line_crf.train(table["documents"], table["labels"])
    kept = [d for d in docs if not base(d[1])[5] and line_crf.judge(d[1] or "", field)[6]]
    best = {}
    for d in kept:
        norm = SPACE.sub("", d[1] or "")
        if norm not in best or (-len(d[1]), d[0]) < (-len(best[norm][1]), best[norm][0]):
            best[norm] = d
    kept = list(best.values())
    first = {k for k, n, c in near([d[:2] for d in kept]) if k == c}
    kept = [d for d in kept if d[0] in first]
    owners = {}
    found = {}
    for k, t, source, _ in kept:
        spans = secrets.base_spans(t)
        found[k] = sorted(spans + secrets.candidate_spans(t, spans))
        for s in found[k]:
            owners.setdefault(s[3], set()).add(source)
    want = {}
    for k, t, _, _ in kept:
        out, at = [], 0
        for s, _, e, v in found[k]:
            if len(owners[v]) <= secrets.MAX_LIVE_OWNERS and s >= at:
                out += [t[at:s], "[SECRET]"]
                at = e
            elif len(owners[v]) <= secrets.MAX_LIVE_OWNERS:
                at = max(at, e)
        want[k] = "".join(out) + t[at:]
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    whole.encode_special_tokens = True
    rows = corpus_pipeline.run(spark, SF).collect()
    got, fill = {}, {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(got.setdefault(r.doc_id, []))
        got[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert got == {k: [*whole.encode(t, add_special_tokens=False).ids, 1] for k, t in want.items()}
    assert max(fill.values()) <= 2048


def test_labelled_clean_documents_stay(spark):
    labels = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/labels.parquet' JOIN '{SF}/documents.parquet' USING (doc_id) WHERE quality = 1").fetchall()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, SF).select("doc_id").collect()}
    assert all(k in kept for k, t in labels if not base(t)[5])


def test_columns_and_stage_order(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_dedup", "near_dedup", "secret_redaction", "packing"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns


def test_entry_registers_every_operator():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(bool(re.match(rf"op{n}_", x)) for x in names) == 1
    assert set(entry.oracle_sql()) <= set(names)


CLASHES = ["_d", "_t", "_k", "_md5", "live_spans", "row", "a.dotted name", "comp", "n", "spans", "c0", "norm"]


@pytest.mark.parametrize("name", [k for k, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_of_any_name(spark, name):
    """Columns named like a stage's own, null texts and ids, repeated rows."""
    docs = duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet' LIMIT 300").fetchall()
    docs += [docs[0], docs[0], (None, None, None, None, None), (7000, None, "en", "s", 0), (7001, "password = hunter22secret9 and more words here", "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    plain = spark.createDataFrame(docs, schema).repartition(3)
    extra = plain.toDF(*plain.columns)
    for c in CLASHES:
        extra = extra.withColumns({c: F.lit(c)}) if "." not in c else extra.select("*", F.lit(c).alias(c))
    stage = dict(corpus_pipeline.STAGES)[name]
    got, want = stage(spark, extra, SF), stage(spark, plain, SF)
    assert got.columns == extra.columns
    rows = got.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert all(tuple(r)[5:] == tuple(CLASHES) for r in rows)
