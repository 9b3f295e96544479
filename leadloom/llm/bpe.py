"""Byte-pair encoding by a merge-type prefix table.

For every prefix of a chunk the table stores the one token that ends its encoding. The candidates are the pieces that
end there (automaton matches, longest first); a candidate follows the last token of what is before it exactly if the
two, encoded together, stay those two. The number of tokens of the prefix follows by one addition, and walking back
over the stored tokens gives the ids. A chunk is a run of spaces with the word behind it, or a line end: no piece
crosses these borders, so chunks are independent and repeated ones are looked up in a bounded cache.
"""

from __future__ import annotations

import re

import ahocorasick
import sentencepiece

from leadloom.llm.common import of_stage

SPACE = "▁"
CHUNKS = re.compile(r"▁*[^▁\n]+|▁+|\n").findall
CACHED_CHUNKS, CACHED_LENGTH = 400_000, 48  # about 100 bytes each, and the value


class PrefixTables:
    """Encoder for a merge-type sentencepiece model with byte fallback and a leading space."""

    def __init__(self, model_file: str):
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.piece, self.ids, self.score, self.bytes = {}, {}, {}, {}
        self.byte_of: dict[int, int] = {}
        self.matches = ahocorasick.Automaton()
        for i in range(library.vocab_size()):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.byte_of[i] = int(piece[3:5], 16)
            elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
                if "\n" in piece or SPACE in piece.lstrip(SPACE):
                    raise ValueError(f"pieces that cross a word's border are not supported: {piece!r}")
                self.ids[piece], self.piece[i], self.score[piece] = i, piece, library.get_score(i)
                self.matches.add_word(piece, (len(piece), i))
        self.matches.make_automaton()
        scores = sorted(self.score.values())
        #: pieces that share a score: their order of merging depends on places, so chunks with them are merged plainly
        self.tied = {p for p, s in self.score.items() if scores[0] == s} if scores[0] == scores[1] else set()
        self.fits: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        #: longest piece of spaces alone: merging a run from its left makes as many of it as there is room for
        self.wide = max((len(p) for p in self.ids if not p.strip(SPACE)), default=1)
        self.few = [self.plain(SPACE * k) for k in range(3 * self.wide + 1)]
        if any(self.few[k + self.wide] != [self.ids[SPACE * self.wide], *self.few[k]] for k in range(2 * self.wide + 1)):
            raise ValueError("runs of spaces are not merged from their left")

    def merged(self, text: str) -> list[str]:
        """Plain merging: always the best-scored neighbours, the first of equals."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, left: int, right: int) -> bool:
        a, b = self.piece[left], self.piece[right]
        fits = self.fits[left << 20 | right] = self.merged(a + b) == [a, b]
        if len(self.fits) > 2_000_000:
            self.fits.clear()
        return fits

    def _whole(self, token: int) -> bool:
        whole = self.whole[token] = len(self.merged(self.piece[token])) == 1
        return whole

    def table(self, chunk: str) -> tuple[list[int], list[int], list[int]]:
        """For each prefix of ``chunk``: its last token, where that begins, the count of tokens.

        A token below 0 is a character outside the vocabulary, ``-1 - code point``, which counts as its bytes.
        """
        n = len(chunk)
        last, begin, count = [-1] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        fits, whole, done = self.fits, self.whole, 0
        for end, (length, token) in self.matches.iter(chunk):
            end += 1
            if end == done:
                continue
            while done + 1 < end:  # characters that no piece ends at
                done += 1
                self._byte(chunk, done, last, begin, count)
            start = end - length
            if start == 0 or last[start] < 0:
                good = whole.get(token)
                if good is None:
                    good = self._whole(token)
            else:
                good = fits.get(last[start] << 20 | token)
                if good is None:
                    good = self._fits(last[start], token)
            if good:
                last[end], begin[end], count[end], done = token, start, count[start] + 1, end
        while done < n:
            done += 1
            self._byte(chunk, done, last, begin, count)
        return last, begin, count

    def _byte(self, chunk, end, last, begin, count):
        character = chunk[end - 1]
        if character in self.ids:
            raise AssertionError(f"no token ends at {end} of {chunk!r}")
        last[end], begin[end] = -1 - ord(character), end - 1
        count[end] = count[end - 1] + len(character.encode("utf-8", "surrogatepass"))

    def plain(self, chunk: str) -> list[int]:
        ids = []
        for part in self.merged(chunk):
            ids.extend([self.ids[part]] if part in self.ids else [self.bytes[b] for b in part.encode()])
        return ids

    def run_ids(self, spaces: int) -> list[int]:
        """The ids of a run of spaces."""
        return [self.ids[SPACE * self.wide]] * (spaces // self.wide) + self.few[spaces % self.wide]

    def run_count(self, spaces: int) -> int:
        return spaces // self.wide + len(self.few[spaces % self.wide])

    def chunk_ids(self, chunk: str) -> tuple[int, ...]:
        if self.tied and SPACE * 2 in chunk:
            spaces = len(chunk) - len(chunk.lstrip(SPACE))
            return tuple(self.run_ids(spaces)) if spaces == len(chunk) else self.spaced(chunk, spaces)
        last, begin, _ = self.table(chunk)
        ids, at = [], len(chunk)
        while at:
            if last[at] >= 0:
                ids.append(last[at])
            else:
                ids.extend(self.bytes[b] for b in reversed(chunk[at - 1].encode()))
            at = begin[at]
        return tuple(reversed(ids))

    def spaced(self, chunk: str, spaces: int) -> tuple[int, ...]:
        """A word behind several spaces: all merges within the word come first, then those of the spaces before it."""
        word = self.chunk_ids(chunk[spaces - 1:])
        first = self.piece.get(word[0], "")
        if first.startswith(SPACE) and first != SPACE:
            return (*self.run_ids(spaces - 1), *word)
        return (*self.run_ids(spaces), *word[1:])

    def counts(self, chunk: str) -> list[int]:
        """Count of tokens of each prefix of ``chunk``, from one character on."""
        if not (self.tied and SPACE * 2 in chunk):
            return self.table(chunk)[2][1:]
        spaces = len(chunk) - len(chunk.lstrip(SPACE))
        found = [self.run_count(k) for k in range(1, spaces + 1)]
        if spaces < len(chunk):
            last, begin, count = self.table(chunk[spaces - 1:])
            joins = [False] * len(last)  # whether the first token of a prefix holds the space and more
            for end in range(1, len(last)):
                joins[end] = joins[begin[end]] if begin[end] else last[end] >= 0 and self.piece[last[end]] != SPACE
            with_it, alone = self.run_count(spaces - 1), self.run_count(spaces) - 1
            found.extend(count[end] + (with_it if joins[end] else alone) for end in range(2, len(last)))
        return found

    def total(self, chunk: str) -> int:
        """Count of tokens of the whole chunk: that of its last prefix."""
        if not (self.tied and SPACE * 2 in chunk):
            return self.table(chunk)[2][-1]
        spaces = len(chunk) - len(chunk.lstrip(SPACE))
        if spaces == len(chunk):
            return self.run_count(spaces)
        return self.counts(chunk)[-1]

    def coded(self, chunk: str) -> tuple[int, bytes, bytes]:
        """How many ids a chunk has, the ids as text, and the text that they decode to."""
        ids = self.chunk_ids(chunk)
        return len(ids), ",".join(map(str, ids)).encode(), self.decoded(ids)

    def decoded(self, ids) -> bytes:
        """The text of the ids of a chunk, a space for each space."""
        parts = []
        for i in ids:
            piece = self.piece.get(i)
            parts.append(bytes([self.byte_of[i]]) if piece is None else piece.replace(SPACE, " ").encode())
        return b"".join(parts)


def chunks_of(text: str) -> list[str]:
    """The chunks of a text, with the space that the model puts before it; none of an empty text."""
    return CHUNKS(SPACE + text.replace(" ", SPACE)) if text else []


def tables(model_file: str) -> PrefixTables:
    return of_stage(("tables", model_file), lambda: PrefixTables(model_file))


def cached(model_file: str, what: str, most: int) -> "Cached":
    """The values of a method of the tables by chunk, known to all tasks of a stage in a worker."""
    return of_stage((what, model_file, most), lambda: Cached(getattr(tables(model_file), what), most))


class Cached(dict):
    """``chunk -> value``; short chunks are stored, and all are forgotten beyond a fixed number."""

    def __init__(self, value, most: int = CACHED_CHUNKS):
        super().__init__()
        self.value, self.most = value, most

    def __missing__(self, chunk):
        value = self.value(chunk)
        if len(chunk) <= CACHED_LENGTH:
            if len(self) >= self.most:
                self.clear()
            self[chunk] = value
        return value
