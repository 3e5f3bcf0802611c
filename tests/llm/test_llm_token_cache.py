import cases
import public_tokenizers
from tokenizers import Tokenizer

from ldspark.llm import token_cache

PATH = public_tokenizers.path("word_bpe_49k.json")


def counts(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_counts_equal_the_library(spark):
    rows = cases.documents()
    found = token_cache.count_tokens(cases.clashing(spark, rows), PATH).collect()
    told = sorted((str(r.id), r.n_bytes, r.n_tokens) for r in found)
    assert told == sorted((str(r[0]), len((r[1] or "").encode()), n) for r, n in zip(rows, counts([r[1] for r in rows])))


def test_words_are_counted_alone_as_within_texts():
    odd = ["é x", "́ ́a", "AΣ BΣx", "a b c", "it's I'LL", "<|endoftext|>x <|startoftext|> <|ENDOFTEXT|>", "\x1c a\x1db", "1234 5\n6"]
    assert token_cache.WordCounter(PATH).count(odd) == counts(odd)


def test_only_distinct_misses_are_encoded(spark, tmp_path):
    rows = cases.documents()
    docs, cache = cases.frame(spark, rows), f"file://{tmp_path}/cache"
    token_cache.count_tokens(docs.limit(20), PATH, cache).collect()
    version = token_cache.tokenizer_digest(PATH)
    stored = token_cache.read_cache(spark, cache, version).count()
    again = token_cache.count_tokens(docs, PATH, cache)
    assert again.count() == len(rows)
    runs = spark.read.parquet(f"{cache}/tokenizer={version}")
    assert runs.count() == runs.select("content").distinct().count() > stored
    token_cache.count_tokens(docs, PATH, cache)
    assert spark.read.parquet(f"{cache}/tokenizer={version}").count() == runs.count()


def test_known_words_are_bounded(monkeypatch):
    monkeypatch.setattr(token_cache, "KEPT_WORDS", 5)
    texts = [r[1] or "" for r in cases.documents()][:12]
    counter = token_cache.WordCounter(PATH)
    assert [counter.count([t])[0] for t in texts] == counts(texts)


def test_empty_table(spark):
    assert token_cache.count_tokens(cases.frame(spark, []), PATH).count() == 0
