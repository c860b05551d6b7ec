"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and scores of a model file become a double-array trie (``base`` and
``check`` over bytes, white-space marker as a plain blank), built once on the
driver and broadcast.  In a task all distinct segments of a slice run through
the Viterbi recursion in lockstep, one text position at a time; a character
that no piece covers costs the lowest score less ten and falls back to byte
pieces.  A segment ends before every blank and around every character that
occurs in no piece; no piece crosses such a border, so the result is that of
the whole text.

Scores are taken as log probabilities.  A file of merge ranks (BPE) holds none;
there rank r stands for the Zipf probability 1 / (r + 1) over their sum; of the
pieces the file switches off (below -1e8) the single characters rank last and
the others are not used.

Ties: the path whose last differing piece starts first.  Defined cases: null
and empty texts have no tokens and decode to the empty string; a non-empty text
gets one leading blank, which decoding takes off again; a literal U+2581 is
encoded by its bytes, so every text survives the round trip.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytes_ import prefix_hash, ragged, slices, span_hash, text_view

#: Longest segment that runs in lockstep with others; longer ones run one by one.
LOCKSTEP = 256
BLANK = 0x20


class DoubleArray:
    """Static trie over byte strings: state s goes by byte c to base[s] + c + 1 if check there is s."""

    def __init__(self, words: list[bytes]):
        order = sorted(range(len(words)), key=words.__getitem__)
        size = 300 + 4 * sum(map(len, words))
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        empty = np.ones(size, bool)
        empty[0], check[0] = False, 0
        low, window = 0, 4096  # no room for a fork is left below low
        stack = [(0, 0, len(order), 0)]  # state, range of sorted words, depth
        while stack:
            state, a, b, depth = stack.pop()
            kids = []
            while a < b:
                word = words[order[a]]
                if len(word) == depth:
                    value[state] = order[a]
                    a += 1
                    continue
                c, end = word[depth], a + 1
                while end < b and words[order[end]][depth] == c:
                    end += 1
                kids.append((c, a, end))
                a = end
            if not kids:
                continue
            steps = np.array([c + 1 for c, _, _ in kids])
            at = low
            while True:
                fits = empty[at + steps[0]: at + steps[0] + window].copy()
                for step in steps[1:]:
                    fits &= empty[at + step: at + step + window]
                if fits.any():
                    break
                low = max(low, at + window) if len(kids) <= 2 else low
                at += window
            at += int(fits.argmax())
            base[state] = at
            check[at + steps] = state
            empty[at + steps] = False
            stack.extend((at + c + 1, lo, hi, depth + 1) for c, lo, hi in kids)
        used = int(np.flatnonzero(~empty)[-1]) + 300
        self.base, self.check, self.value = base[:used].copy(), check[:used].copy(), value[:used].copy()


class Pieces:
    """Vocabulary arrays of a model file; read on the driver only."""

    def __init__(self, model_path: str, scores: str = "auto"):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = m.get_piece_size()
        raw = np.array([m.get_score(i) for i in range(n)])
        zipf = scores == "zipf" or (scores == "auto" and raw[raw > -1e8].min() < -1000)
        special = np.array([m.is_control(i) or m.is_unknown(i) or m.is_unused(i) for i in range(n)])
        byte = np.array([m.is_byte(i) for i in range(n)])
        text = [m.id_to_piece(i) for i in range(n)]
        used = ~special & ~byte & ~(zipf & (raw <= -1e8) & (np.array(list(map(len, text))) > 1))
        spell = [t.replace("▁", " ").encode() for t in text]
        self.byte_id = np.full(256, -1, np.int32)
        for i in np.flatnonzero(byte):
            spell[i] = bytes([int(text[i][3:5], 16)])
            self.byte_id[spell[i][0]] = i
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces to fall back to")
        for i in np.flatnonzero(special):
            spell[i] = b""
        ids = np.flatnonzero(used)
        if zipf:
            rank = np.where(raw[ids] > -1e8, -raw[ids], len(raw))
            weight = 1 / (1 + rank)
            self.score = np.log(weight / weight.sum())
        else:
            self.score = raw[ids]
        self.score = np.round(self.score * 2 ** 20) / 2 ** 20  # sums are exact, so ties are ties
        self.piece_id = ids.astype(np.int32)
        self.unknown = float(self.score.min()) - 10
        self.trie = DoubleArray([spell[i] for i in ids])
        self.longest = max(len(spell[i]) for i in ids)
        self.spell = np.frombuffer(b"".join(spell), np.uint8)
        self.spell_at = np.cumsum([0, *map(len, spell)])
        self.solo = np.zeros(256, bool)  # ASCII that is in no piece
        self.solo[:128] = True
        for i in ids:
            self.solo[list(set(spell[i]))] = False
            if b" " in spell[i][1:]:
                raise ValueError("a piece with an inner white-space marker would cross segments")

    # -- encoding ---------------------------------------------------------
    def _lockstep(self, text: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, ...]:
        """(segment, start, end, piece or -1) of the best paths of segments of similar length."""
        n, width = len(starts), int(lens.max())
        m = np.zeros((n, width + 4), np.uint8)
        col = np.arange(width)
        inside = col < lens[:, None]
        m[:, :width][inside] = text[(starts[:, None] + col)[inside]]
        best = np.full((n, width + 5), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, width + 5), np.int32)
        piece = np.full((n, width + 5), -1, np.int32)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        for i in range(width):
            row = np.flatnonzero((lens > i) & (best[:, i] > -np.inf))
            lead = m[row, i]
            char = 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
            char = np.minimum(char, lens[row] - i)
            known = np.zeros(n, bool)
            unit = np.zeros(n, np.int64)
            unit[row] = char
            every, state = row, np.zeros(len(row), np.int32)
            for d in range(min(self.longest, width - i)):
                to = base[state] + m[row, i + d] + 1
                ok = (check[to] == state) & (lens[row] > i + d)
                row, state = row[ok], to[ok]
                if not len(row):
                    break
                at = value[state]
                ends = at >= 0
                r, a = row[ends], at[ends]
                known[r[unit[r] == d + 1]] = True
                score = best[r, i] + self.score[a]
                better = score > best[r, i + d + 1]
                r, a, score = r[better], a[better], score[better]
                best[r, i + d + 1], back[r, i + d + 1], piece[r, i + d + 1] = score, i, a
            r = every[~known[every]]
            end = i + unit[r]
            score = best[r, i] + self.unknown
            better = score > best[r, end]
            r, end = r[better], end[better]
            best[r, end], back[r, end], piece[r, end] = score[better], i, -1
        seg, s, e, p = [], [], [], []
        row, end = np.arange(n), lens.astype(np.int64)
        while len(row):
            begin = back[row, end]
            seg.append(row), s.append(begin), e.append(end), p.append(piece[row, end])
            row, end = row[begin > 0], begin[begin > 0].astype(np.int64)
        seg, s, e, p = map(np.concatenate, (seg, s, e, p))
        order = np.lexsort((s, seg))
        return seg[order], s[order].astype(np.int64), e[order], p[order]

    def segments(self, text: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all segments one after the other, tokens per segment)."""
        seg, begin, end, piece = [], [], [], []
        edges = [0, 4, 8, 12, 16, 24, 32, 64, 128, LOCKSTEP]
        for lo, hi in zip(edges, edges[1:]):
            which = np.flatnonzero((lens > lo) & (lens <= hi))
            for part in np.array_split(which, max(1, len(which) * hi // (1 << 20))):
                if len(part):
                    g, b, e, p = self._lockstep(text, starts[part], lens[part])
                    seg.append(part[g]), begin.append(starts[part][g] + b), end.append(starts[part][g] + e), piece.append(p)
        for k in np.flatnonzero(lens > LOCKSTEP):
            b, e, p = self._single(text[starts[k]: starts[k] + lens[k]].tobytes())
            seg.append(np.full(len(b), k)), begin.append(starts[k] + b), end.append(starts[k] + e), piece.append(p)
        if not seg:
            return np.zeros(0, np.int32), np.zeros(len(starts), np.int64)
        seg, begin, end, piece = map(np.concatenate, (seg, begin, end, piece))
        order = np.argsort(seg, kind="stable")
        seg, begin, end, piece = seg[order], begin[order], end[order], piece[order]
        many = np.where(piece >= 0, 1, end - begin)  # an unknown character gives its bytes
        out = np.repeat(np.where(piece >= 0, self.piece_id[piece], -1), many).astype(np.int32)
        raw = text[ragged(begin, many)]
        out = np.where(out >= 0, out, self.byte_id[raw])
        return out, np.bincount(seg, many, len(starts)).astype(np.int64)

    def _single(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same recursion for one long segment."""
        n, score = len(text), self.score
        base, check, value = memoryview(self.trie.base), memoryview(self.trie.check), memoryview(self.trie.value)
        best, back, piece = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            if here == -np.inf:
                continue
            lead = text[i]
            unit = min(1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0), n - i)
            state, known = 0, False
            for j in range(i, min(n, i + self.longest)):
                to = base[state] + text[j] + 1
                if check[to] != state:
                    break
                state = to
                if (a := value[state]) >= 0:
                    known |= j + 1 - i == unit
                    if (s := here + score[a]) > best[j + 1]:
                        best[j + 1], back[j + 1], piece[j + 1] = s, i, a
            if not known and here + self.unknown > best[i + unit]:
                best[i + unit], back[i + unit], piece[i + unit] = here + self.unknown, i, -1
        ends = [n]
        while back[ends[-1]]:
            ends.append(back[ends[-1]])
        ends = ends[::-1]
        return (np.array([back[e] for e in ends], np.int64), np.array(ends, np.int64),
                np.array([piece[e] for e in ends], np.int32))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(token ids, tokens per row, prefixed text, its bytes per row)."""
        raw, offs = text_view(column)
        size = np.diff(offs)
        full = size > 0
        size = size + full
        text = np.empty(int(size.sum()), np.uint8)
        at = np.cumsum(size) - size
        blank = np.zeros(len(text), bool)
        blank[at[full]] = True
        text[blank], text[~blank] = BLANK, raw
        cut = (text == BLANK) | self.solo[text]
        cut[1:] |= self.solo[text[:-1]]
        cut[at[full]] = True
        starts = np.flatnonzero(cut)
        lens = np.diff(np.append(starts, len(text)))
        h = span_hash(prefix_hash(text), starts, starts + lens)
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        ids, many = self.segments(text, starts[first], lens[first])
        begin = np.cumsum(many) - many
        out = ids[ragged(begin[which], many[which])]
        owner = np.searchsorted(at[full], starts, "right") - 1
        count = np.zeros(len(size), np.int64)
        count[full] = np.bincount(owner, many[which], int(full.sum())).astype(np.int64)
        return out, count, text, size

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(prefixed text, its bytes per row): the spelling of all tokens."""
        lens = self.spell_at[ids + 1] - self.spell_at[ids]
        text = self.spell[ragged(self.spell_at[ids], lens)]
        total = np.concatenate([[0], np.cumsum(lens)])
        ends = np.cumsum(counts)
        return text, total[ends] - total[ends - counts]


def encode(docs: DataFrame, pieces: Pieces, keep: list[str], *, text_col: str = "text",
           with_ids: bool = True) -> DataFrame:
    """``keep`` columns of every row, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian 32-bit
    integers), ``round_trip`` (decoding gives the text back) and, ``with_ids``, ``token_ids``."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    rows = docs.select(F.col(text_col).alias("_text"), *keep)
    schema = docs.select(*keep).schema.add("n_tokens", "integer").add("ids_sha256", "string").add("round_trip", "boolean")
    if with_ids:
        schema = schema.add("token_ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            ids, counts, text, size = shared.value.encode(part.column(0))
            back, back_size = shared.value.decode(ids, counts)
            ends, at = np.cumsum(counts), np.concatenate([[0], np.cumsum(size)])
            same = back_size == size
            if same.all():
                wrong = np.concatenate([[0], np.cumsum(back != text)])
                same = wrong[at[1:]] == wrong[at[:-1]]
            data = ids.astype("<i4").tobytes()
            digest = [hashlib.sha256(data[4 * (e - c): 4 * e]).hexdigest() for e, c in zip(ends, counts)]
            columns = [*part.columns[1:], pa.array(counts.astype(np.int32)), pa.array(digest, pa.string()), pa.array(same)]
            if with_ids:
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, pieces: Pieces, keep: list[str], *, ids_col: str = "token_ids") -> DataFrame:
    """``keep`` columns of every row and ``text``; bytes that are no UTF-8 become U+FFFD, null ids an empty text."""
    shared = tokens.sparkSession.sparkContext.broadcast(pieces)
    rows = tokens.select(F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("_ids"), *keep)
    schema = tokens.select(*keep).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ids, counts = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(lists.value_lengths(), np.int64)
            text, size = shared.value.decode(np.asarray(ids, np.int64), counts)
            ends, data = np.cumsum(size), text.tobytes()
            out = [data[e - n: e].removeprefix(b" ").decode("utf-8", "replace") for e, n in zip(ends.tolist(), size.tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(out, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)
