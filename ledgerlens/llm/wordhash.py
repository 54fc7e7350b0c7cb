"""64-bit hashes of the words of many texts at once, in numpy.

Texts are joined into one byte array. With a random number T[b] for each byte value and an odd base r, prefix sums of
T[byte] * r**place (modulo 2**64) give the sum of any stretch; dividing by r**start, which has an inverse, makes it independent
of the place. A final mix spreads the bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Bytes of text that are hashed at once; a longer text is hashed by itself.
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True

R = 0x9E3779B97F4A7C15
R_INVERSE = pow(R, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A number for each byte value.
EXACT = mix(np.arange(1, 257, dtype=np.uint64))
#: The same, A-Z as a-z.
_BYTES = EXACT.copy()
_BYTES[65:91] = _BYTES[97:123]


def powers(base: int, n: int) -> np.ndarray:
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        size = max(n, CHUNK_BYTES + 1)
        held = np.empty(size, dtype=np.uint64)
        held[0] = 1
        done = 1
        while done < size:  # doubling: the next stretch is the first times a constant
            more = min(done, size - done)
            held[done : done + more] = held[:more] * np.uint64(pow(base, done, 1 << 64))
            done += more
        if size <= CHUNK_BYTES + 1:
            _POWERS[base] = held
    return held[:n]


def word_hashes(texts: Sequence[bytes], space: np.ndarray = SPACE, heads: Sequence[int] = (), values: np.ndarray = _BYTES) -> tuple[np.ndarray, ...]:
    """Hashes of all words of the texts in order, and how many words each text has; then hashes of the words' first ``heads`` bytes.

    ``values`` has a number for each byte value: A-Z count as a-z, with ``EXACT`` they do not.
    """
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    with np.errstate(over="ignore"):
        gap = space[joined]
        edge = np.diff(np.concatenate([[True], gap]).astype(np.int8))
        starts = np.flatnonzero(edge == -1)
        ends = np.flatnonzero(edge == 1)
        prefix = np.zeros(len(joined) + 1, dtype=np.uint64)
        np.cumsum(values[joined] * powers(R, len(joined)), out=prefix[1:])
        begin, scale = prefix[starts], powers(R_INVERSE, len(joined) + 1)[starts]
        hashes = [mix((prefix[end] - begin) * scale) for end in (ends, *(np.minimum(ends, starts + n) for n in heads))]
    last = np.cumsum([len(t) + 1 for t in texts])
    return hashes[0], np.diff(np.searchsorted(starts, last), prepend=0), *hashes[1:]


def chunks(texts: Sequence[str | bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, encoded texts) in stretches of about ``CHUNK_BYTES``; a missing text is empty."""
    first, held, size = 0, [], 0
    for at, text in enumerate(texts):
        raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
        if held and size + len(raw) > CHUNK_BYTES:
            yield first, held
            first, held, size = at, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """The sorted distinct ``k``-word shingles of each text; fewer words make one shingle, no words none."""
    out = []
    with np.errstate(over="ignore"):
        n = len(hashes) - k + 1
        if n > 0:
            rolled = np.full(n, k, dtype=np.uint64)
            for j in range(k):
                rolled = (rolled * np.uint64(R)) ^ hashes[j : j + n]
                rolled = rolled * np.uint64(0xBF58476D1CE4E5B9)
            rolled = mix(rolled)
        at = 0
        for count in counts.tolist():
            if count >= k:
                one = np.sort(rolled[at : at + count - k + 1])
                out.append(one[np.concatenate([[True], one[1:] != one[:-1]])])
            elif count:
                value = np.array([count], dtype=np.uint64)
                for j in range(count):
                    value = ((value * np.uint64(R)) ^ hashes[at + j]) * np.uint64(0xBF58476D1CE4E5B9)
                out.append(mix(value))
            else:
                out.append(np.empty(0, dtype=np.uint64))
            at += count
    return out
