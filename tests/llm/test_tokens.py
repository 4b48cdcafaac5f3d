import random

import public_tokenizers
from tokenizers import Tokenizer

from locuswise.llm.tokens import TokenCounter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


def lib(text):
    return len(LIB.encode(text, add_special_tokens=False).ids)


def test_every_code_point_in_context():
    c = TokenCounter(PATH)
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    rnd = random.Random(1)
    # all code points of the first planes that hold letters and blanks, a sample of the rest
    for ch in chars[:0x3100] + rnd.sample(chars[0x3100:], 3000):
        for t in (ch, f"a{ch}b", f" {ch} 1", f"x {ch}{ch}\n"):
            assert c.count(t) == lib(t), (hex(ord(ch)), t)


def test_random_texts():
    c = TokenCounter(PATH)
    rnd = random.Random(2)
    alphabet = list("ab 's'tT19,.-\n\t  \r éß漢🙂\x1c") + ["<|endoftext|>", "<|endof", "the ", "'ll"]
    for _ in range(4000):
        t = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40)))
        assert c.count(t) == lib(t), repr(t)
    long = "a" * 30_000 + " " + "zq" * 5_000 + " " * 3_000
    assert c.count(long) == lib(long)


def test_rows(spark):
    rows = [(1, None, 9), (None, "", 9), (2, "<|endoftext|>x", 9), (2, "<|endoftext|>x", 9), (3, "the cat " * 2000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(df, PATH).collect()}
    assert got == {(1, 0, 0, False), (None, 0, 0, False), (2, 14, 2, False), (3, 16000, lib("the cat " * 2000), True)}
    assert token_counts(df, PATH).count() == 5
    assert token_counts(df.limit(0), PATH).count() == 0


def test_whole_table(spark):
    from locuswise.llm.queries import load_all

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas()
    got = load_all()["op1_token_counts"].build(spark, "/root/testdata/sf0.001").toPandas().set_index("doc_id")
    want = LIB.encode_batch(docs.text.tolist(), add_special_tokens=False)
    assert [len(e.ids) for e in want] == got.n_tokens.loc[docs.doc_id].tolist()
    assert [len(t.encode()) for t in docs.text] == got.n_bytes.loc[docs.doc_id].tolist()
