import hashlib

import tiktoken

import corpus_pipeline
import public_tokenizers
from tapecraft.llm.bpe import read_ranks
from tapecraft.llm.language_id import identify_languages
from tapecraft.llm.mixing import mix_sources
from tapecraft.llm.repetition import repetition_rules
from tests.llm.test_language_id import text_of
from tests.llm.test_ngram_join import brute as brute_components
from tests.llm.test_ngram_join import chain
from tests.llm.test_repetition import brute as brute_quality
from tests.llm.util import ODD_TEXTS, docs_table, prose

ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=read_ranks(corpus_pipeline.RANK_FILE), special_tokens={})


def rows_of():
    rows = [(i, text_of(["aa", "bb", "cc"][i % 3], i, 60 + i % 50), ["aa", "bb", "cc"][i % 3], f"s{i % 4}") for i in range(90)]
    rows += [(200 + i, rows[i][1], rows[i][2], "copies") for i in range(20)]
    rows += [(300 + i, t, "aa", None) for i, t in enumerate(ODD_TEXTS)] + [rows[5], rows[5]]
    return rows + [(400, (text_of("aa", 1, 12) + "\n") * 9, "aa", "s1"), (None, text_of("bb", 77, 70), "bb", "s2")]


def test_stages_match_brute_force(spark, tmp_path):
    docs_table(spark, rows_of()).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = (before.collect(), docs.collect())
        if name != "bpe_round_trip":
            assert docs.columns == corpus_pipeline.COLUMNS

    before, after = kept["language_id"]
    judged = identify_languages(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()
    assert len(after) == sum(r.lang_pred != "und" and r.score >= 0.5 for r in judged)
    before, after = kept["quality_rules"]
    assert sorted((r.doc_id, r.text) for r in after if r.doc_id is not None) == sorted(
        (r.doc_id, r.text) for r in before if r.doc_id is not None and brute_quality(r.text)[-1])
    before, after = kept["near_duplicates"]
    groups = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in before])}
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(groups)
    assert sum(r.doc_id is None for r in after) == sum(r.doc_id is None for r in before)
    before, after = kept["mix_sources"]
    taken = mix_sources(spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert sorted(str(r.doc_id) for r in after) == sorted(
        str(r.doc_id) for r in taken for _ in range(int(r.taken / r.size + 0.5) if r.size else 0))
    before, after = kept["bpe_round_trip"]
    want = [(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(r.text.encode()).hexdigest()) for r in before for ids in [ENCODING.encode_ordinary(r.text)]]
    assert sorted(map(tuple, after), key=str) == sorted(want, key=str)


def test_run_and_empty_table(spark, tmp_path):
    docs_table(spark, rows_of()).write.parquet(f"{tmp_path}/a/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/a").columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    docs_table(spark, []).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").collect() == []


def test_rows_without_an_id_that_others_stand_for_go(spark):
    a, b, c = chain(41)
    d, e, f = chain(42)
    rows = [(1, a), (None, b), (None, a), (2, c), (None, d), (None, e), (None, f), (None, d), (None, None), (3, None), (4, "")]
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.duplicates(spark, docs_table(spark, rows), "").collect()]
    single = [t for i, t in kept if i is None and t]
    assert len(single) == 1 and single[0] in (d, e, f)
    assert sorted(kept, key=str) == sorted([(1, a), (None, single[0]), (None, None), (3, None), (4, "")], key=str)


def test_repeats_that_pass_the_base_rule_are_rejected(spark):
    def unlike(seed, words):
        return prose(seed, words, 5000)

    line = unlike(1, 20)
    texts = {1: " ".join([unlike(2, 45), unlike(3, 110), unlike(2, 45)]),  # 45 % one passage said twice
             2: " ".join([unlike(4, 30), unlike(5, 60), unlike(4, 30), unlike(6, 60), unlike(4, 30)]),
             3: "\n".join([line, unlike(7, 40), line, unlike(8, 40), line]),
             4: unlike(9, 300), 5: " ".join([unlike(10, 12), unlike(11, 276), unlike(10, 12)])}
    docs = docs_table(spark, list(texts.items()))
    assert not any(r.base_failed for r in repetition_rules(docs).collect())
    assert sorted(r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, "").collect()) == [4, 5]
