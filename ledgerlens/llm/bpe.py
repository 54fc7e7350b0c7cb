"""Byte-level BPE ids of whole texts.

The library is asked only once for each distinct chunk of text that a worker meets. Chunks begin at single spaces or line ends that
stand between two characters that are not white space; the tokenizer's own pre-split always cuts there, so ids of chunks
joined are the ids of the text. Chunks of Latin letters with at most one full stop or comma behind them, nearly all in
most corpora, go through the same model with the pre-split already done, many at a time. A text that holds the literal of
an added token, such as ``<|endoftext|>``, goes to the library whole, which gives that token's id as it does by default. Texts are
cut, their distinct chunks found and the ids put together on whole arrays. When the memory of chunks is full, only those
of the last texts are kept, which changes speed, never ids.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks a worker remembers, and the longest text (characters) it remembers.
MOST_CHUNKS, LONGEST_CHUNK = 700_000, 64
#: Characters that are encoded together; a longer text is encoded by itself.
STRETCH = 6_000_000

_RUN = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_PLAIN = r"\A\n?[A-Za-zÀ-ÖØ-öø-ſ]+[.,]?\z"


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_characters() -> dict[int, str]:
    """The printable character that byte-level BPE writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class ChunkEncoder:
    """Ids of texts as numpy arrays of unsigned 16-bit integers (vocabularies of at most 65,536 ids)."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 65_536:
            raise ValueError("ids of this tokenizer need more than 16 bits")
        plan = json.loads(self.tokenizer.to_str())
        self.added = [t["content"] for t in plan.get("added_tokens") or []]
        self.bare = None
        split = plan.get("pre_tokenizer") or {}
        if split.get("type") == "ByteLevel" and split.get("use_regex") and not plan.get("normalizer"):
            self.bare = Tokenizer.from_str(json.dumps(plan | {"pre_tokenizer": None, "post_processor": None, "added_tokens": []}))
            vocabulary = self.bare.get_vocab()
            self.length = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
            for token, i in vocabulary.items():
                self.length[i] = len(token)
        self.written = byte_characters()
        self._forget()

    def _forget(self) -> None:
        """No chunk is known. The ids of the chunk ``known[r]`` are ``ids[start[r] : start[r + 1]]``."""
        self.known = pa.array([], pa.large_string())
        self.ids, self.start = np.zeros(0, dtype="<u2"), np.zeros(1, dtype=np.int64)

    @staticmethod
    def even(text: str) -> bool:
        """Whether every white-space character stands alone between two others, so that cutting at all spaces and line ends is safe."""
        return not (_RUN.search(text) or text[:1].isspace() or text[-1:].isspace())

    def cut(self, texts: list[str | None]) -> tuple[list[int], np.ndarray, pa.Array]:
        """Places of the texts in another order, how many chunks each has in that order, and all of these chunks.

        A text that may hold the literal of an added token stays whole. After the first of a text, a chunk that does not begin with a line end stands behind a space.
        """
        apart = [not t or any(a in t for a in self.added) for t in texts]
        even = [i for i, t in enumerate(texts) if not apart[i] and self.even(t)]
        odd = sorted(set(range(len(texts))) - set(even))
        lists = [[texts[i] or ""] if apart[i] else _CUT.split(texts[i]) for i in odd]
        counts = [texts[i].count(" ") + texts[i].count("\n") + 1 for i in even] + [len(x) for x in lists]
        joined = pa.array([" ".join(texts[i] for i in even).replace("\n", " \n")] if even else [], pa.large_string())
        chunks = [pc.split_pattern(joined, " ").flatten(), pa.array([c for x in lists for c in x], pa.large_string())]
        return even + odd, np.array(counts, dtype=np.int64), pa.concat_arrays(chunks)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids, dtype="<u2") for e in found]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of letters behind a space or line end, and how many each has: one piece each of the pre-split, so the model alone decides."""
        table = self.written | {0: "\0", 10: "\n"}
        space, line = self.written[32], self.written[10]
        joined = "\0".join(words).encode().decode("latin-1").translate(table)
        split = [w[1:] if w[0] == "\n" else space + w for w in joined.split("\0")]
        ids = np.array(self.bare.encode_batch_fast([split], is_pretokenized=True, add_special_tokens=False)[0].ids, dtype="<u2")
        ends = np.cumsum(np.fromiter(map(len, split), dtype=np.int64, count=len(split)))
        upto = np.searchsorted(np.cumsum(self.length[ids]), ends) + 1
        counts = np.diff(upto, prepend=0)
        head = np.array(self.bare.encode(line, add_special_tokens=False).ids, dtype="<u2")
        lines = np.flatnonzero(np.fromiter((w[0] == "\n" for w in words), dtype=bool, count=len(words)))
        ids = np.insert(ids, np.repeat((upto - counts)[lines], len(head)), np.tile(head, len(lines)))
        counts[lines] += len(head)
        return ids, counts

    def _keep(self, chunks: pa.Array, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Remember chunks that are not known yet; their rows."""
        first = len(self.known)
        self.known = pa.concat_arrays([self.known, chunks])
        self.ids = np.concatenate([self.ids, ids])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(counts)])
        return np.arange(first, len(self.known))

    def _rows(self, chunks: pa.Array) -> np.ndarray:
        """Where the ids of each chunk are, or -1."""
        return pc.fill_null(pc.index_in(chunks, value_set=self.known), -1).to_numpy().astype(np.int64)

    def _ids_of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks in these rows, one after another, and how many each has."""
        counts = self.start[rows + 1] - self.start[rows]
        before = np.cumsum(counts) - counts
        return self.ids[np.arange(counts.sum()) + np.repeat(self.start[rows] - before, counts)], counts

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Remember these chunks, none of them known or the first of a text; their rows."""
        rows = np.zeros(len(new), dtype=np.int64)
        plain = pc.match_substring_regex(new, _PLAIN).to_numpy(zero_copy_only=False) if self.bare else rows > 0
        if plain.any():
            some = new.filter(pa.array(plain))
            words = pc.utf8_rtrim(some, ".,").dictionary_encode()
            known = self._rows(words.dictionary)
            if (known < 0).any():
                unknown = words.dictionary.filter(pa.array(known < 0))
                known[known < 0] = self._keep(unknown, *self._words(unknown.to_pylist()))
            found = known[words.indices.to_numpy()]
            for mark in ".,":
                ending = pc.ends_with(some, mark).to_numpy(zero_copy_only=False)
                if ending.any():
                    ids, counts = self._ids_of(found[ending])
                    last = self._whole([mark])[0]
                    ids = np.insert(ids, np.repeat(np.cumsum(counts), len(last)), np.tile(last, len(counts)))
                    found[ending] = self._keep(some.filter(pa.array(ending)), ids, counts + len(last))
            rows[plain] = found
        if not plain.all():
            rest = new.filter(pa.array(~plain))
            each = self._whole([c if c[:1] == "\n" else " " + c for c in rest.to_pylist()])
            rows[~plain] = self._keep(rest, np.concatenate(each), np.array([len(x) for x in each], dtype=np.int64))
        return rows

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of each text; none for a missing or empty one."""
        texts = list(texts)
        if not texts:
            return []
        order, counts, chunks = self.cut(texts)
        first = np.zeros(len(chunks), dtype=bool)
        first[np.cumsum(counts) - counts] = True
        heads = self._whole(chunks.filter(pa.array(first)).to_pylist())
        coded = chunks.filter(pa.array(~first)).dictionary_encode()
        distinct = coded.dictionary
        short = pc.less_equal(pc.utf8_length(distinct), LONGEST_CHUNK).to_numpy(zero_copy_only=False)
        rows = self._rows(distinct)
        new, long = (rows < 0) & short, (rows < 0) & ~short
        rows[new] = self._learn(distinct.filter(pa.array(new)))
        remembered = len(self.known)
        rows[long] = self._learn(distinct.filter(pa.array(long)))
        ids, sizes = self._ids_of(rows[coded.indices.to_numpy()])
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts - 1)])]
        found: list = [None] * len(texts)
        for i, head, a, b in zip(order, heads, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            found[i] = np.concatenate([head, ids[a:b]])
        # long chunks are the last that were learnt
        self.known, self.ids, self.start = self.known[:remembered], self.ids[: self.start[remembered]], self.start[: remembered + 1]
        if remembered > MOST_CHUNKS:
            kept = rows < remembered
            ids, sizes = self._ids_of(rows[kept])
            self._forget()
            self._keep(distinct.filter(pa.array(kept)), ids, sizes)
        return found


def stretches(texts: Sequence[str | None], most: int = STRETCH) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of texts to encode together: the more at once, the fewer chunks are looked up again."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > first and size + n > most:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(texts):
        yield first, len(texts)


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder of that vocabulary; it outlives a task."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
