"""Token files and packing against the tokenizer itself."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from ledgerlens.llm import bpe, packing, tokenfile
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def plain():
    return bpe.ChunkEncoder(bpe.tokenizer_file()).tokenizer


def ids_of(plain, text):
    return np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")


def test_chunks_give_the_tokenizers_ids(plain):
    rng = np.random.default_rng(1)
    letters = list("ab ,.\n\t'sé5 ßѣ中 \x1c İ")
    odd = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(3000)]
    odd += ["", " ", "\n", "a\n\nb", "don't  stop", "<|endoftext|> x", "x" * 300 + " " + "y" * 300, "a\nb c\nd."]
    enc = bpe.ChunkEncoder(bpe.tokenizer_file())
    for _ in range(2):  # the second time from memory
        assert [x.tolist() for x in enc.encode(odd)] == [plain.encode(t, add_special_tokens=False).ids for t in odd]


def test_literals_of_added_tokens_as_by_default(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.tokenizer_file())
    rows = ["a <|endoftext|> b", "<|endoftext|>", "x\n<|endoftext|>\ny <|endoftext|><|endoftext|>", "<|endo ftext|> a <|endoftext |>", "one two", "", "a <|endoftext|>b.\n\n  c"]
    expected = [library.encode(t, add_special_tokens=False).ids for t in rows]
    enc = bpe.ChunkEncoder(bpe.tokenizer_file())
    for _ in range(2):
        assert [x.tolist() for x in enc.encode(rows)] == expected
    assert 50256 in expected[0]
    packed = packing.pack(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["length"] for r in packed} == {k: len(ids) + 1 for k, ids in enumerate(expected)}
    assert {r["doc_id"]: r["ids_crc32"] for r in packed} == {k: zlib.crc32(np.array([*ids, 0], dtype="<u4").tobytes()) for k, ids in enumerate(expected)}


def test_a_full_memory_keeps_the_chunks_of_the_last_texts(plain, monkeypatch):
    """Before, it was emptied, and the library was asked for the commonest words again and again."""
    monkeypatch.setattr(bpe, "MOST_CHUNKS", 3)
    enc, asked, words = bpe.ChunkEncoder(bpe.tokenizer_file()), [], bpe.ChunkEncoder._words
    monkeypatch.setattr(bpe.ChunkEncoder, "_words", lambda self, new: asked.extend(new) or words(self, new))
    first = ["One of the\nwords, and  the others.", "z" * 70 + " y" * 3 + " " + "x" * 70 + ".", None]
    second = ["and of the ѣ é's\tx", "Now then, one\nwords.", ""]
    for texts, new in ((first, None), (first, {"x" * 70}), (second, None), (second, set())):
        asked.clear()
        assert [x.tolist() for x in enc.encode(texts)] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert new is None or set(asked) == new  # long chunks are never kept
        assert len(enc.known) == len(enc.start) - 1 and enc.start[-1] == len(enc.ids)


def test_code_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 3, 4, 5, 1000):
        values = rng.integers(0, 2 ** rng.integers(1, 32, n), n).astype(np.uint32)
        controls, data = tokenfile.encode_ranks(values)
        assert len(controls) == -(-n // 4)
        assert (tokenfile.decode_ranks(controls, data, n) == values).all()
    with pytest.raises(ValueError):
        tokenfile.decode_ranks(b"\x00", b"abc", 4)


def test_files_hold_all_ids(spark, docs, texts, plain, tmp_path):
    path = str(tmp_path / "tokens")
    tokenfile.write_tokens(docs, path, block_tokens=5000)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in tokenfile.read_tokens(spark, path).collect()}
    at, expected = 0, {}
    for key in sorted(texts):
        ids = ids_of(plain, texts[key])
        expected[key] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert got == expected
    blocks = tokenfile.read_blocks(spark, path).orderBy("part", "block").collect()
    assert [r["start"] for r in blocks] == np.cumsum([0, *[r["n_tokens"] for r in blocks]])[:-1].tolist()
    order = [k for r in blocks for k in r["doc_ids"]]
    assert order == sorted(order)


def test_odd_rows_of_files(spark, frame, tmp_path):
    tokenfile.write_tokens(frame(ODD), str(tmp_path / "odd"))
    rows = tokenfile.read_tokens(spark, str(tmp_path / "odd")).collect()
    assert len(rows) == len(ODD) and rows and min(r["start"] for r in rows) == 0
    assert sum(r["n_tokens"] == 1 for r in rows) == 3
    tokenfile.write_tokens(frame([]), str(tmp_path / "none"))
    assert tokenfile.read_tokens(spark, str(tmp_path / "none")).count() == 0


def check_packing(rows, lengths, capacity):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0, *[n for _, n in held]])[:-1].tolist()
        assert sum(n for _, n in held) <= capacity
    for key, n in lengths.items():
        own = sorted(pieces[key])
        assert [p for p, _, _ in own] == list(range(len(own))) and sum(x for _, _, x in own) == n
        assert [s for _, s, _ in own] == np.cumsum([0, *[x for _, _, x in own]])[:-1].tolist()
        assert all(x == capacity for _, _, x in own[1:])
    return len(sequences)


def test_packing_is_whole_and_tight(docs, texts, plain):
    rows = packing.pack(docs).collect()
    lengths = {k: len(ids_of(plain, t)) for k, t in texts.items()}
    used = check_packing(rows, lengths, packing.CAPACITY)
    least = -(-sum(lengths.values()) // packing.CAPACITY)
    assert used <= 1.01 * least + 1
    for r in rows[:50]:
        ids = ids_of(plain, texts[r["doc_id"]])[r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(ids.tobytes())


def test_odd_rows_of_packing(frame):
    assert packing.pack(frame([])).count() == 0
    rows = packing.pack(frame([(k, t) for k, t in enumerate(t for _, t in ODD)]), capacity=64).collect()
    assert {r["doc_id"] for r in rows} == set(range(len(ODD)))
    assert max(r["length"] for r in rows) <= 64


def test_numbers_of_a_common_length_are_not_dealt_by_length(spark):
    rows = [(k, 0, 7 if k % 3 else k % 11 + 1) for k in range(3000)]
    df = packing.numbered(spark.createDataFrame(rows, "row long, piece int, length long"))
    found = defaultdict(list)
    for r in df.collect():
        found[r["length"]].append(r["number"])
    assert all(sorted(v) == list(range(len(v))) for v in found.values()) and sum(map(len, found.values())) == 3000
    plan = df._jdf.queryExecution().executedPlan().toString()
    first = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert first.count("Exchange hashpartitioning(length") == 1  # that of the totals


def test_knapsack_against_all_configurations():
    rng = np.random.default_rng(3)
    prices = np.zeros(13)
    prices[[3, 4, 5, 7]] = rng.random(4)

    def brute(room):
        return max([0.0, *[prices[n] + brute(room - n) for n in (3, 4, 5, 7) if n <= room]])

    best, _ = packing.knapsack(prices, 12)
    assert np.allclose(best, [brute(c) for c in range(13)])


def used_up(plan, histogram, capacity):
    left = histogram.copy()
    for lengths, n in plan:
        assert n > 0 and sum(lengths) <= capacity
        np.subtract.at(left, list(lengths), n)
    return not left.any()


@pytest.mark.parametrize("units", [8, 32])
def test_plan_uses_up_any_histogram(monkeypatch, units):
    monkeypatch.setattr(packing, "UNITS", units)
    rng = np.random.default_rng(4)
    for _ in range(20):
        histogram = np.zeros(33, dtype=np.int64)
        histogram[rng.integers(1, 33, 12)] = rng.integers(1, 5000, 12)
        plan, solution = packing.plan_sequences(histogram, 32)
        assert used_up(plan, histogram, 32)
        least = (histogram * np.arange(33)).sum() / 32
        if units == 32:
            assert solution.bound >= least - 1e-6
        assert sum(n for _, n in plan) <= solution.value + 13
    assert packing.plan_sequences(np.zeros(33, dtype=np.int64), 32) == ([], packing.Solution([], 0.0, 0.0))


def least_sum(need, lengths, capacity):
    """Optimum of the covering program by all its vertices: as many columns (configurations or surplus) as lengths."""
    configs = [c for c in itertools.product(*[range(capacity // n + 1) for n in lengths]) if 0 < np.dot(c, lengths) <= capacity]
    columns = [(np.array(c, dtype=float), 1.0) for c in configs] + [(-row, 0.0) for row in np.eye(len(lengths))]
    best = np.inf
    for chosen in itertools.combinations(columns, len(lengths)):
        matrix = np.array([c for c, _ in chosen]).T
        if abs(np.linalg.det(matrix)) > 1e-9:
            x = np.linalg.solve(matrix, need)
            if (x > -1e-9).all():
                best = min(best, float(np.dot(x, [cost for _, cost in chosen])))
    return best


@pytest.mark.parametrize("lengths", [(3, 5, 7), (2, 5, 9), (4, 6, 11), (5, 7, 8)])
def test_program_against_all_configurations(lengths):
    rng = np.random.default_rng(5)
    for _ in range(4):
        histogram = np.zeros(13, dtype=np.int64)
        histogram[list(lengths)] = rng.integers(20, 300, 3)
        solution = packing.solve(histogram, 12, phases=40)
        optimum = least_sum(histogram[list(lengths)], lengths, 12)
        assert solution.bound - 1e-6 <= optimum <= solution.value + 1e-6
        assert solution.value <= 1.1 * optimum
        for lengths_used, share in solution.used:
            assert share > 0 and sum(lengths_used) <= 12


@pytest.mark.parametrize(("sf", "share"), [("sf0.01", 0.8), ("sf0.1", 0.9)])  # the fewer pieces of a length, the more is left to rounding
def test_sequences_come_from_the_program(plain, sf, share):
    rows = pq.read_table(f"/root/testdata/{sf}/documents.parquet", columns=["text"]).column("text").to_pylist()
    histogram = np.zeros(packing.CAPACITY + 1, dtype=np.int64)
    for first in range(0, len(rows), 500):
        for found in plain.encode_batch([t or "" for t in rows[first : first + 500]], add_special_tokens=False):
            for _, n in packing.piece_bounds(len(found.ids) + 1, packing.CAPACITY):
                histogram[n] += 1
    plan, solution = packing.plan_sequences(histogram, packing.CAPACITY)
    assert used_up(plan, histogram, packing.CAPACITY)
    assert solution.value - solution.bound <= packing.GAP * solution.bound
    sequences = sum(n for _, n in plan)
    assert sequences <= np.ceil(solution.bound) + 2
    own, whole = dict(packing.whole_numbers(solution.used)), 0
    for lengths, n in plan:
        whole += min(n, own.get(tuple(sorted(lengths, reverse=True)), 0))
    assert whole >= share * sequences


def test_largest_remainders():
    used = [((5,), 2.6), ((4,), 0.7), ((3,), 0.4), ((2,), 0.3)]
    assert packing.whole_numbers(used) == [((5,), 3), ((4,), 1)]
