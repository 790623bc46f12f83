"""Each pipeline stage against a brute-force version on its own input, and the whole run."""

import random

import pytest

import corpus_pipeline
from courtside.llm import quality_rules, queries, secrets
from courtside.llm.tokens import encoder
from tests.llm import test_decontaminate, test_ngram_join, test_quality_rules
from tests.llm.helpers import DOC_SCHEMA


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    texts, marks = test_quality_rules.corpus(180, 4)
    rng = random.Random(8)
    bench = [(f"b{k}", " ".join(rng.choices([f"q{j}" for j in range(60)], k=20))) for k in range(6)]
    for k in range(0, 40, 9):
        texts[k + 2] = texts[k + 2] + " " + bench[k % 6][1]  # contaminated, unless the text is long
        texts[k + 3] = bench[k % 6][1].upper() + " and a few words after it that are not"
        texts[k + 4] = texts[k + 5].replace(" ", "  ", 3)  # same words
        texts[k + 6] = " ".join(texts[k + 7].split()[:-1])  # near copy
        texts[k + 8] = texts[k + 8] + ' password = "0123456789abcdef0123456789abcdef" and passphrase is correct-Zx9!horse$battery'
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)] + [(500, None, None, None, None), (501, "", "en", "s", 0), (3, texts[3], "en", "s", 1)]
    spark.createDataFrame(rows, DOC_SCHEMA).repartition(3).write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame([(k, m, 0) for k, m in enumerate(marks)], "doc_id long, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    spark.createDataFrame(bench, "item_id string, text string").write.parquet(str(root / "benchmark.parquet"))
    return str(root), bench


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages(spark, folder):
    root, bench = folder
    docs = spark.read.parquet(f"{root}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "decontamination", "secret_scan", "packing"]

    good = stages["quality_rules"](spark, docs, root)
    assert good.columns == docs.columns
    verdict = {(r["doc_id"]): r["kept"] for r in quality_rules.verdicts(docs, spark.read.parquet(f"{root}/labels.parquet")).collect()}
    assert rows_of(good) == sorted((tuple(r) for r in docs.collect() if verdict[r["doc_id"]]), key=str)
    assert 0 < good.count() < docs.count()

    single = stages["near_duplicates"](spark, good, root)
    assert single.columns == docs.columns
    pairs = [(r["doc_id"], r["text"]) for r in good.collect()]
    first = {c for _, n, c in test_ngram_join.brute(pairs) if n}
    assert sorted(str(r["doc_id"]) for r in single.collect() if r["text"]) == sorted(first)
    assert single.count() < good.count()

    clean = stages["decontamination"](spark, single, root)
    assert clean.columns == docs.columns
    items = [(i, test_decontaminate.plain_words(t)) for i, t in bench]

    def contaminated(text):
        own = test_decontaminate.plain_words(text)
        n_hit = test_decontaminate.brute(own, items)[0]
        return n_hit > 0 and 20 * n_hit >= len(own)

    assert rows_of(clean) == sorted((tuple(r) for r in single.collect() if not contaminated(r["text"])), key=str)
    assert clean.count() < single.count()

    masked = stages["secret_scan"](spark, clean, root)
    assert masked.columns == docs.columns
    want = {r["doc_id"]: secrets.mask_text(r["text"], secrets.scan_text(r["text"])) for r in clean.collect() if r["text"]}
    got = {r["doc_id"]: r["text"] for r in masked.collect() if r["text"]}
    assert got == want and any("[SECRET]" in t for t in got.values())

    packed = stages["packing"](spark, masked, root).collect()
    tok = encoder(queries.TOKENIZER).tokenizer
    total = sum(len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in masked.collect())
    assert sum(r["length"] for r in packed) == total
    by = {}
    for r in packed:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))] and sum(x for _, x in own) <= 4096

    whole = corpus_pipeline.run(spark, root)
    assert sorted((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"]) for r in whole.collect()) == \
        sorted((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"]) for r in packed)


def test_registered_queries_match_their_oracles(spark):
    from tests.conftest import SF_SMALL
    from tests.oracle_harness import compare, duck
    con = duck(SF_SMALL)
    for name, sql in queries.ORACLE_SQL.items():
        res = compare(spark, name, queries.QUERIES[name], sql, SF_SMALL, con)
        assert res["status"] == "match", res
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
