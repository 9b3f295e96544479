"""Static range asymmetric numeral system over token ids, in numpy.

A block is coded by up to ``LANES`` interleaved states of 64 bits that take turns over the tokens and share one stream
of 32-bit words. Each step works on all lanes at once. Every ``CHECKPOINT`` steps the states and the place in the stream
are stored, so that a part of a block can be decoded without what is before it.
"""

from __future__ import annotations

import numpy as np

BITS, LOW, LANES, CHECKPOINT = 20, 1 << 31, 4096, 64
_U = np.uint64


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of ``2**BITS``, at least 1 for each id that occurs."""
    counts = np.asarray(counts, dtype=np.int64)
    seen = np.flatnonzero(counts)
    if len(seen) > 1 << BITS:
        raise ValueError(f"more than {1 << BITS} different ids")
    freq = np.zeros(len(counts), dtype=np.int64)
    if not len(seen):
        return freq
    room = (1 << BITS) - len(seen)
    freq[seen] = 1 + (counts[seen].astype(object) * room // int(counts.sum())).astype(np.int64)
    freq[seen[np.argmax(counts[seen])]] += (1 << BITS) - int(freq.sum())
    return freq


class Tables:
    """What coder and decoder look up: frequency and start of each id, id of each slot."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(_U)
        self.start = (np.cumsum(freq) - freq).astype(_U)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def lanes_for(n: int) -> int:
    return max(1, min(LANES, n // 64))


def encode(tokens: np.ndarray, tables: Tables) -> dict:
    """``lanes, states, words, marks`` of one block; ``marks`` are ``(words before, states)`` at each checkpoint."""
    n, lanes = len(tokens), lanes_for(len(tokens))
    state = np.full(lanes, LOW, dtype=_U)
    freq, start = tables.freq[tokens], tables.start[tokens]
    if n and not freq.all():
        raise ValueError("a token has no frequency")
    out, written, marks = [], 0, []
    steps = -(-n // lanes)
    for step in range(steps - 1, -1, -1):
        f, s = freq[step * lanes:(step + 1) * lanes], start[step * lanes:(step + 1) * lanes]
        x = state[:len(f)]
        full = x >= f << _U(31 - BITS + 32)
        if full.any():
            emitted = x[full]
            out.append(emitted.astype(np.uint32))
            written += len(emitted)
            x[full] = emitted >> _U(32)
        q, r = np.divmod(x, f)
        state[:len(f)] = (q << _U(BITS)) + r + s
        if step and step % CHECKPOINT == 0:
            marks.append((written, state.copy()))
    words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
    return {"lanes": lanes, "states": state, "words": words, "marks": [(len(words) - w, s) for w, s in reversed(marks)]}


def decode(n: int, block: dict, tables: Tables, first: int = 0, last: int | None = None) -> np.ndarray:
    """Tokens ``first`` to ``last`` of a block of ``n``, from the nearest checkpoint on."""
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, np.uint32)
    lanes, words = block["lanes"], block["words"]
    mark = min(first // lanes // CHECKPOINT, len(block["marks"]))
    at, state = (block["marks"][mark - 1][0], block["marks"][mark - 1][1].copy()) if mark else (0, block["states"].copy())
    step, out = mark * CHECKPOINT, []
    begin = step * lanes
    while step * lanes < last:
        x = state[:min(lanes, n - step * lanes)]
        slot = x & _U((1 << BITS) - 1)
        symbol = tables.symbol[slot]
        x = tables.freq[symbol] * (x >> _U(BITS)) + slot - tables.start[symbol]
        low = np.flatnonzero(x < _U(LOW))
        x[low] = (x[low] << _U(32)) | words[at:at + len(low)].astype(_U)
        at += len(low)
        state[:len(x)] = x
        out.append(symbol)
        step += 1
    return np.concatenate(out)[first - begin:last - begin]
