"""Cross-tokenizer alignment against a brute-force version over byte ranges."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from corpus_fixtures import clashing, documents, sf

from curbwise.llm import alignment, queries


@pytest.fixture(scope="module")
def known():
    return alignment.Tokenizers(alignment.default_paths())


def brute_spans(known, text):
    """(id, start, end) of A's and B's tokens, from the libraries one text at a time."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    out = []
    if not text:
        return [], []
    for ids, table in ((a.encode(" " + text, add_special_tokens=False).ids, known.a_bytes), (b.encode(text), known.b_bytes)):
        at, spans = 0, []
        for i in ids:
            spans.append((i, at, at + len(table[i])))
            at += len(table[i])
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return [], []
        out.append(spans)
    return out


def brute(known, rows):
    spans = {k: brute_spans(known, text) for k, text in {text: text for _, text in rows}.items()}
    links = {k: [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for k, (a, b) in spans.items()}
    total = Counter(p for _, text in rows for p in links[text])
    most = Counter()
    for (_, y), n in total.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, text in rows:
        a, b = spans[text]
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        shown = ";".join(",".join(str(x[0]) for x in a if lo < x[2] <= hi) + "|" + ",".join(str(y[0]) for y in b if lo < y[2] <= hi)
                         for lo, hi in zip([0, *ends], ends))
        mine = links[text]
        out.append((doc_id, len(a), len(b), len(ends), len(mine), sum(total[p] == most[p[1]] for p in mine),
                    sum(total[p] for p in mine), hashlib.sha256(shown.encode()).hexdigest() if a else ""))
    return out


TEXTS = ["Hello world", "", None, "a", " leading and  double  spaces ", "naïve café — Grüße, mañana! 你好，世界 🙂🙂", "<|endoftext|> and </s><s> <unk>",
         "▁ holds the piece mark", "tab\tand\nlines\r\n\n", "x" * 300, "0123456789 " * 5, "<0x41> ▂", "é   ​ zero\x00byte", "Hello world"]


def test_op12_matches_brute_force(spark, known, tmp_path, monkeypatch):
    rng = random.Random(1)
    alphabet = "abcdefghij  \n\té你🙂ß-"
    rows = list(enumerate(TEXTS)) + [(100 + i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200)))) for i in range(60)]
    rows += [(None, "Hello no id")]
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 2000)
    got = queries.op12_token_alignment(spark, sf(tmp_path, documents=clashing(documents(spark, rows)).repartition(3)))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 7 + ["string"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(known, rows), key=str)


def test_links_of_slices_are_the_overlaps(known):
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice("ab  é你🙂\n.\u3000'") for _ in range(rng.randrange(1, 40)))
        (a, b), = known.encode([text])
        units = list(known.encode(known.units(text)))
        assert (a, b) == (sum((x for x, _ in units), []), sum((y for _, y in units), []))
        got = alignment.Alignment(a, b, known)
        x, y = brute_spans(known, text)
        want = [(i, j) for i, p in enumerate(x) for j, q in enumerate(y) if p[1] < q[2] and q[1] < p[2]]
        assert sorted(zip(*(x.tolist() for x in got.links()))) == want


def test_units_of_whole_texts_of_the_given_table(known):
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist() if t]
    for text, (a, b) in zip(texts, known.encode(texts)):
        units = list(known.encode(known.units(text)))
        assert (a, b) == (sum((x for x, _ in units), []), sum((y for _, y in units), []))


def test_groups_and_pair_counts(spark, known):
    docs = documents(spark, [(1, "Hello world"), (2, "Hello world"), (3, None)])
    rows = {r.doc_id: r for r in alignment.groups(docs).collect()}
    assert rows[1].a_ids == rows[2].a_ids and rows[3].a_ids == []
    assert rows[1].a_ends[-1] == len(rows[1].a_ids) and rows[1].b_ends[-1] == len(rows[1].b_ids)
    pairs = alignment.pair_counts(docs).collect()
    assert sum(r.links for r in pairs) == 2 * len(alignment.Alignment(rows[1].a_ids, rows[1].b_ids, known).links()[0])
    assert any(r.best for r in pairs)


def test_long_text_and_empty_table(spark, known):
    text = "Grüße from afar " * 20_000
    got = alignment.counts(documents(spark, [(1, text)])).first()
    (a, b), = known.encode([text])
    assert (got.n_a, got.n_b) == (len(a), len(b)) and got.n_links >= max(len(a), len(b))
    assert alignment.counts(documents(spark, [])).count() == 0
    assert alignment.counts(documents(spark, [(1, None), (2, "")])).count() == 2


def test_texts_are_cut_at_spaces_between_printing_characters(known):
    shown = r"[^\s\x00-\x20\x7f-\xa0\u180e\u200b]"
    cut, rng = re.compile(f"(?<={shown}) (?={shown})"), random.Random(2)
    for alphabet in ("ab  ", "a \n\t", "a  é你🙂\u3000\u200b\u180e\xa0\x85\x7f\x1c"):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(9))) for _ in range(500)]
        units, bounds = known.cut(pa.array(["left out", *texts], pa.large_string())[1:])
        units = units.to_pylist()
        assert [units[a:b] for a, b in zip(bounds, bounds[1:])] == [cut.split(t) if t else [] for t in texts]
        at = known.printing(pa.array(units, pa.large_string()))
        assert at.tolist() == [bool(re.match(shown, u[0]) and re.match(shown, u[-1])) for u in units]


def test_op12_forgetting_units_changes_nothing(spark, known, tmp_path, monkeypatch):
    rows = list(enumerate(TEXTS + [f"Hello world{i % 7} and x{i}" for i in range(60)]))
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 200)
    monkeypatch.setattr(alignment, "KNOWN_CHARS", 50)
    units, got = alignment.Units(alignment.default_paths()), []
    for i, text in rows:
        numbers, _ = units.numbers(pa.array([text or ""], pa.large_string()))
        got.append(hashlib.sha256(units.printed(numbers)).hexdigest() if len(numbers) else "")
    assert len(units._names) < 20
    assert got == [r[-1] for r in brute(known, rows)]
    table = queries.op12_token_alignment(spark, sf(tmp_path, documents=documents(spark, rows).coalesce(1)))
    assert sorted(map(tuple, table.collect()), key=str) == sorted(brute(known, rows), key=str)


def test_a_workers_units_take_little_memory():
    """The check tool ended the query at 3 GB of an executor: every unit took several Python objects."""
    units = alignment.Units(alignment.default_paths())
    texts = pa.array([" ".join(f"{i:x}{j:x}ing" for j in range(100)) for i in range(300)], pa.large_string())
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    rows = units.numbers(texts)[0]
    after = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert len(set(rows.tolist())) > 25_000
    assert after / len(set(rows.tolist())) < 180  # bytes; 286 as Python objects
