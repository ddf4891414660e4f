import numpy as np
from tokenizers import Tokenizer

from hoopflow.llm import mixing, tokens

TEXTS = [
    "We stopped running,” he said — don't!", "", " ", None, "\n\n  x\t y z ", "😂👨‍👩‍👧 中鋒 得分", "a" * 20000, "<|endoftext|> is text", "1234567 ½ Ⅷ ٣", "We'll they'd I'm 's'", "\u0000\u001c\u0085x",
    "é İ ß ﬁ", "word " * 500,
]


def test_ids_equal_the_tokenizer_and_decode(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)] + [(3, "twice", "en"), (3, "twice", "en"), (None, "no id", "en")], "doc_id long, text string, word string")
    own = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    own.encode_special_tokens = True
    encoded = tokens.encode(docs).collect()
    want = sorted((str(r["doc_id"]), own.encode(r["text"], add_special_tokens=False).ids if r["text"] is not None else []) for r in docs.collect())
    assert sorted((str(r["doc_id"]), r["ids"]) for r in encoded) == want
    back = {r["doc_id"]: r["text"] for r in tokens.decode(tokens.encode(docs.where("doc_id <> 3")), spark).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS) if i != 3}


def test_hot_word_and_rare_words_meet(spark):
    docs = spark.createDataFrame([(i, ("hot " * 50) + f"w{i} {'q' * 100}") for i in range(200)], "doc_id long, text string")
    e = tokens.Encoded(docs)
    assert e.head.count() <= e.table.count() <= e.table.select("word").distinct().count()
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(docs).collect()}
    assert counts == {r["doc_id"]: len(r["ids"]) for r in tokens.encode(docs).collect()}


def test_long_frequent_words_are_spread(spark):
    lines = [("-" * (100 + i % 3) + f" x{i}") for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    assert {r["n"] for r in tokens.Encoded(docs).heavy.collect()} == {40}
    own = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    assert {r["doc_id"]: r["ids"] for r in tokens.encode(docs).collect()} == {i: own.encode(t, add_special_tokens=False).ids for i, t in enumerate(lines)}


def test_no_documents(spark):
    assert tokens.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pivot_keeps_the_sum_and_leaves_one_fraction():
    rng = np.random.default_rng(1)
    for _ in range(30):
        w, p = rng.integers(1, 500, 200).astype(float), rng.random(200)
        q = mixing.pivot(w, p, rng)
        assert abs((w * p).sum() - (w * q).sum()) < 1e-4 * w.sum() and ((q > 0) & (q < 1)).sum() <= 1
    hits = np.mean([mixing.pivot(np.array([3.0, 1.0, 2.0]), np.array([0.3, 0.5, 0.9]), np.random.default_rng(k)) for k in range(4000)], axis=0)
    assert np.abs(hits - [0.3, 0.5, 0.9]).max() < 0.05


def test_shares_and_caps(spark):
    r = np.random.default_rng(5)
    sized = spark.createDataFrame(
        [(i, s, int(r.integers(0, 400))) for i, s in enumerate(["big"] * 3000 + ["mid"] * 500 + ["small"] * 20)] + [(9000, None, 50), (9001, "mid", 0)], "doc_id long, source string, n_tokens long"
    )
    targets = spark.createDataFrame(
        [("m", "big", 2.0, 1), ("m", "small", 1.0, 7), ("m", "void", 1.0, 3), ("m", "mid", 0.0, 1), ("n", "mid", 0.5, 2), ("n", "big", 0.5, 0), ("o", "void", 1.0, 1), ("p", "mid", float("nan"), None)],
        "mix_id string, source string, target_share double, max_repeats int",
    )
    old = mixing.BLOCK
    mixing.BLOCK = 16  # many blocks, two levels
    try:
        chosen = mixing.choose(sized, targets)
        rows = chosen.collect()
    finally:
        mixing.BLOCK = old
    assert max(x["copies"] for x in rows if x["source"] == "small") <= 7 and max(x["copies"] for x in rows if x["source"] == "big") == 1
    assert len({(x["mix_id"], x["doc_id"]) for x in rows}) == len(rows)
    s = {(x["mix_id"], x["source"]): x for x in mixing.shares(chosen, sized, targets).collect()}
    assert abs(s["m", "big"]["reached_share"] - 2 / 3) < 0.02 and abs(s["m", "small"]["reached_share"] - 1 / 3) < 0.02
    assert s["m", "void"]["tokens"] == 0 and s["m", "mid"]["tokens"] == 0 and s["n", "mid"]["reached_share"] == 1.0 and s["o", "void"]["reached_share"] == 0.0
    planned = s["m", "big"]["planned_copies"] * s["m", "big"]["available"]
    assert abs(s["m", "big"]["tokens"] - planned) < 400


def test_no_mix(spark):
    sized = spark.createDataFrame([], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("m", "x", 1.0, 1)], "mix_id string, source string, target_share double, max_repeats int")
    assert mixing.choose(sized, targets).count() == 0
