"""The registered queries at a small scale, and the pipeline against brute force."""

import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import check
import corpus_pipeline
from grantlens.llm import language, pii
from grantlens.llm.queries import all_queries, all_sql
from brute_force import least_reachable

SF_DIR = "/root/testdata/sf0.001"

# The columns each query has to return.
COLUMNS = {
    "op1_toxicity": {"doc_id", "severity"},
    "op2_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op3_exact_top_k": {"query_id", "rank", "vec_id", "score"},
    "op4_source_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op5_pseudonyms": {"doc_id", "text"},
    "op6_minhash": {"doc_id", "n_shingles", "component_id", "kept"},
    "op7_simhash": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op8_substring_dedup": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op9_language": {"doc_id", "held_out", "lang_pred", "score"},
    "op10_sequence_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op12_alignment": {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"},
    "op13_quality": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op11_divergence": {"lang", "source", "part", "item", "value", "rank"},
}


def test_the_driver_sees_all_queries():
    assert set(all_queries()) == {*COLUMNS, "pipeline"} <= set(contract.queries())
    assert set(all_sql()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    found = all_queries()[name](spark, SF_DIR)
    assert COLUMNS[name] <= set(found.columns)
    if name not in ("op3_exact_top_k", "op10_sequence_packing", "op11_divergence"):
        assert found.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_equals_its_sql(spark, name):
    verdict, _ = check.compare(spark, check.connect(SF_DIR), name, SF_DIR)
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("name", ["op4_source_mixing", "op7_simhash"])
def test_native_queries_run_no_python(spark, name):
    plan = all_queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Pandas", "Arrow") if word in plan]


def documents():
    draw = random.Random(9)
    syllables = {"en": ["the", "ing", "er", "an"], "de": ["sch", "en", "ung", "ö"]}
    rows = []
    for k in range(150):
        lang = draw.choice(["en", "de"])
        words = ["".join(draw.choices(syllables[lang], k=draw.randint(2, 5))) for _ in range(draw.randint(6, 150))]
        rows.append((k, " ".join(words) + " mail me.11@host.example.com", lang, draw.choice(["a", "b", None]), 0))
    rows += [(200 + k, r[1] if k % 2 else r[1] + " end", r[2], "b", 0) for k, r in enumerate(rows[:60])]
    rows += [(300, None, "en", "a", 0), (301, "12 34", "en", "a", 0), (302, "", None, None, 0), rows[3]]
    return rows


def test_pipeline_stage_by_stage(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(documents(), schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], str(tmp_path)).cache())
    raw, known, single, private, mixed, packed = ([r.asDict() for r in f.collect()] for f in frames)
    assert [f.columns for f in frames[:5]] == [docs.columns] * 5

    # language: what has letters of a language that was learned stays
    letters = [r for r in raw if language.has_letter(r["text"])]
    assert Counter(map(str, known)) == Counter(map(str, letters))
    # near copies: the smallest id of each group
    order = sorted(known, key=lambda r: r["doc_id"])
    root, _ = least_reachable([r["text"] for r in order])
    assert sorted(map(str, single)) == sorted(str(order[k]) for k in set(root))
    # pseudonyms: the same rows with new texts
    assert sorted(map(str, private)) == sorted(str(r | {"text": pii.pseudonymized(r["text"])[0]}) for r in single)
    assert not any("me.11@" in r["text"] for r in private)
    # mixing: whole documents, words near the targets
    wanted = Counter(map(str, private))
    assert set(map(str, mixed)) <= set(wanted) and max(Counter(map(str, mixed)).values()) <= 2
    sizes, taken = defaultdict(int), defaultdict(int)
    for rows, into in ((private, sizes), (mixed, taken)):
        for r in rows:
            into[r["source"]] += len(r["text"].split())
    assert all(taken[s] <= 2 * n for s, n in sizes.items())
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 3 * 160
    # packing: every copy in pieces of its own
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    copies = Counter(r["doc_id"] for r in mixed)
    assert Counter(p["doc_id"] for p in packed if p["start"] == 0) == copies
    lengths = Counter()
    for p in packed:
        lengths[p["sequence_id"]] += p["length"]
    assert max(lengths.values()) <= 4096
    ids = {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in mixed}
    assert sum(lengths.values()) == sum(ids[k] * n for k, n in copies.items())


def test_run_writes_and_reads_each_stage(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_pipeline_of_nothing(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
