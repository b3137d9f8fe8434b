"""The registered queries of this package, and the pipeline."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from searchtide.llm import queries, sql
from tests.conftest import SMALL
from tools.compare import compare, tables

CONTRACT = {
    1: ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"], 2: ["tokens", "n_tokens", "exact"],
    3: ["held_out", "lang_pred", "score"], 4: ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    5: ["fingerprint", "component_id"], 6: ["n_words", "n_removed", "kept_sha256"],
    7: ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"], 8: ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    9: ["size", "source_size", "target", "taken"], 10: ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    11: ["n_features", "weight", "score", "rank"], 12: ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    13: ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
}


def test_all_are_registered():
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries()) and set(sql.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, name):
    verdict, _, rows = compare(spark, tables(SMALL), SMALL, name)
    assert verdict == ("ok" if name in sql.oracle_sql() else "rows only")
    number = int(name[2:].split("_")[0])
    table = {7: "pages", 12: "conversations", 13: "conversations"}.get(number, "documents")
    key = {"pages": "page_id", "conversations": "conv_id"}.get(table, "doc_id")
    whole = spark.read.parquet(f"{SMALL}/{table}.parquet")
    # query 12 has a conversation of its own
    assert rows == (whole.count() if table != "conversations" else whole.select(key).distinct().count() + (number == 12))
    columns = queries.queries()[name](spark, SMALL).columns
    assert set(CONTRACT[number]) | {key} <= set(columns)


def test_pipeline(ready):
    docs = ready.read.parquet(f"{SMALL}/documents.parquet")
    rows, before = docs, docs.count()
    for name, stage in corpus_pipeline.STAGES[:4]:
        rows = stage(ready, rows, SMALL)
        assert rows.columns == docs.columns, name
        if name in ("quality_rules", "simhash_near_dedup"):
            assert 0.5 * before < rows.count() < before
            before = rows.count()
    out = corpus_pipeline.run(ready, SMALL)
    assert out.where("not exact").count() == 0 and out.count() == rows.count()
    assert out.select("doc_id").distinct().count() > 0.3 * before
