import random
import zlib

import numpy as np
import pytest
from corpus_fixtures import clashing, documents, sf
from tokenizers import Tokenizer

from curbwise.llm import huffman as H, queries
from curbwise.llm.tokens import WordEncoder, default_path

TEXTS = [None, "", "  it's a <|endoftext|> x<|endoftext|>. été… ça— «bon». ﬁ é. é. O'Reilly's\n\t12.5% İstanbul ΣΑΣ. 你好。 naïve!! a b c. ''s <|STARTOFTEXT|>",
         "The the THE the. the, the&&& (the) 'the' the's", "\x0b\x0c\x1c x y   z", "word " * 9000, "é" * 500, "\U0001f600 á Å"]


def library(texts):
    tok = Tokenizer.from_file(default_path())
    return [e.ids + [2] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_equal_the_library_in_slices_of_batches():
    import pyarrow as pa

    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice(["ab", "cd.", "Éf,", "gh's", "1", "ij!!", "kl|mn"]) + str(rng.randrange(99)) for _ in range(rng.randrange(200))) for _ in range(300)]
    batch = pa.record_batch([pa.array(texts)], ["t"]).slice(3)
    got = []
    import curbwise.llm.tokens as tokens

    old, tokens.BATCH_BYTES = tokens.BATCH_BYTES, 5000
    try:
        for rows, ids, bounds in WordEncoder(default_path()).batches(batch, 0):
            got += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    finally:
        tokens.BATCH_BYTES = old
    assert got == library(texts[3:])


def test_the_store_of_units_and_the_library_results_stay_bounded(monkeypatch):
    import pyarrow as pa

    import curbwise.llm.tokens as tokens

    monkeypatch.setattr(tokens, "KNOWN_UNITS", 400)
    monkeypatch.setattr(tokens, "_AT_ONCE", 50)
    monkeypatch.setattr(tokens, "_BY_PATH", {})
    encoder = WordEncoder(default_path())
    units, at_once = encoder._units, []

    class Spy:
        def __init__(self, tok):
            self.encode = tok.encode
            self.encode_batch_fast = lambda some, **kw: at_once.append(len(some)) or tok.encode_batch_fast(some, **kw)

    units._tok = Spy(units._tok)
    # 200 units are in every batch, beside 150 of its own: a store that forgets all would encode them again
    texts = [[" ".join(f"u{i}" for i in range(200)), " ".join(f"v{b}x{i}" for i in range(150))] for b in range(6)]
    for some in texts:
        ids, bounds = encoder.encode(pa.array(some))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == library(some)
        assert len(units._known) <= 400 and len(units._starts) == len(units._sizes) == len(units._known)
    assert max(at_once) <= 50 and sum(at_once) <= 200 + 6 * 150 + 1


def huffman_cost(counts):
    import heapq

    heap, cost = list(map(int, counts)), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


@pytest.mark.parametrize("n", [2, 3, 17, 1000])
def test_code_lengths_are_optimal_and_limited(n):
    rng = np.random.default_rng(n)
    counts = rng.integers(1, 50, n)
    assert (H.code_lengths(counts) * counts).sum() == huffman_cost(counts)
    steep = np.array([1 << min(i, 50) for i in range(n)], np.int64)
    lengths = H.code_lengths(steep, 12)
    assert lengths.max() <= 12 and (0.5 ** lengths).sum() <= 1


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n) - 1, 49000).astype(np.int64)
    symbols, counts = np.unique(np.append(ids, 7), return_counts=True)
    book = H.Codebook(symbols, H.code_lengths(counts))
    codes, lengths = book.encoder()
    payload, checkpoints = H.encode_block(ids, codes, lengths)
    assert H.decode_block(payload, checkpoints, n, *book.decoder(), book.max_bits).tolist() == ids.tolist()


def test_files_round_trip(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.randrange(10**6), t) for t in TEXTS * 3] + [(None, "no id"), (5, "twice"), (5, "twice"), (5, "other")]
    df = clashing(documents(spark, rows))
    path = H.write_tokens(df, str(tmp_path / "set"))
    got = sorted(H.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    at = 0
    for r in got:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    want = sorted((-1 if r[0] is None else r[0], ids) for r, ids in zip(rows, library([r[1] for r in rows])))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == want


def test_query_and_empty_table(spark, tmp_path):
    d = sf(tmp_path / "a", documents=documents(spark, [(2, "b a"), (1, None)]))
    ids = library(["b a"])[0]
    assert sorted(map(tuple, queries.op6_token_output(spark, d).collect())) == [
        (1, 0, 1, zlib.crc32(np.array([2], "<u4").tobytes())), (2, 1, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))]
    assert queries.op6_token_output(spark, sf(tmp_path / "b", documents=documents(spark, []))).count() == 0


def test_ids_beyond_16_bits_keep_their_width(spark, tmp_path):
    """The width comes from the tokenizer file: one with an id of 70,000."""
    import json

    from tokenizers import Tokenizer

    from curbwise.llm import huffman, tokens
    made = json.load(open(tokens.default_path()))
    made["model"]["vocab"]["zzzzzq</w>"] = 70_000
    made["added_tokens"].append({"id": 70_001, "content": "qqqqx", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False})
    made["model"]["vocab"]["qqqqx"] = 70_001
    path = str(tmp_path / "t.json")
    json.dump(made, open(path, "w"))
    assert huffman.id_type(path, 2) == "<u4" and huffman.id_type(tokens.default_path(), 2) == "<u2" and huffman.id_type(tokens.default_path(), 1 << 16) == "<u4"
    folder = huffman.write_tokens(documents(spark, [(1, "one two"), (2, "qqqqx one")]), str(tmp_path / "f"), tokenizer=path)
    got = {r["doc_id"]: list(memoryview(bytes(r["ids"])).cast("I")) for r in huffman.read_tokens(spark, folder).collect()}
    whole = Tokenizer.from_file(path)
    assert got == {i: whole.encode(t, add_special_tokens=False).ids + [2] for i, t in ((1, "one two"), (2, "qqqqx one"))}
    assert max(got[2]) >= 1 << 16
