"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The pieces, scores and settings come from a given model file; nothing is trained. A text's
segmentation is the one with the largest sum of piece scores (the unigram rule of
SentencePiece, whatever way the vocabulary was learned), characters without a piece go to
byte pieces, and on equal sums the piece that starts first wins."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import in_chunks, mixed

SPACE = "▁"
CACHED, CACHED_LENGTH, STEP = 300_000, 40, 1 << 20
_caches: dict[int, dict[str, bytes]] = {}  # of this process, by vocabulary: kept from task to task
UNKNOWN_PENALTY = 10.0  # below the smallest score, as SentencePiece has it


@dataclass
class Vocabulary:
    """Pieces of a model. words: id and score by text; longest: of them, in characters; bytes:
    the id of each byte piece, empty without byte fallback; text: by id, None for control pieces."""

    words: dict[str, tuple[int, float]]
    bytes: list[int]
    text: list[str | bytes | None]
    unknown: int
    prefix: bool
    cuts_at_space: bool = False
    longest: int = 0
    least: float = 0.0
    heads: dict[str, int] = field(default_factory=dict)  # by first character, the longest piece
    table: _Lookup | None = None  # made by a worker when it first needs it
    raw: list[bytes] = field(default_factory=list)  # by id, the bytes that a piece stands for

    def __post_init__(self):
        self.longest = max(map(len, self.words), default=1)
        self.least = min((s for _, s in self.words.values()), default=0.0)
        # With no piece that has a space after another character, every path passes the places before spaces.
        self.cuts_at_space = not any(SPACE in w.lstrip(SPACE) for w in self.words)
        self.raw = [t if isinstance(t, bytes) else (t or "").replace(SPACE, " ").encode("utf-8", "surrogatepass") for t in self.text]
        for w in self.words:
            self.heads[w[0]] = max(self.heads.get(w[0], 0), len(w))


def load(path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    words, text, raw = {}, [], {}
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            raw[int(piece[3:-1], 16)] = i
            text.append(bytes([int(piece[3:-1], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            text.append(None)
        else:
            words[piece] = (i, sp.get_score(i))
            text.append(piece)
    if sp.decode([words[w][0] for w in (SPACE + "a", "a") if w in words][:1]) == " a":
        raise ValueError("only models that drop the first space on decoding are supported")
    dummy = sp.encode("a", out_type=str)[0].startswith(SPACE)
    return Vocabulary(words, [raw[b] for b in range(256)] if len(raw) == 256 else [], text, sp.unk_id(), dummy)


def normalised(text: str, v: Vocabulary) -> str:
    """The text that is cut into pieces: spaces are marked, and a first one may be added."""
    return (SPACE if v.prefix and text else "") + text.replace(" ", SPACE)


def viterbi(text: str, v: Vocabulary) -> Iterator[list[int]]:
    """Ids of a normalised text, a list at every place where they are settled.

    Only ends within the longest piece of the current place are open. Their backpointers are
    followed as far as the place where all paths meet; what lies before it is given out and
    forgotten. That is tried whenever no open piece spans the current place, and at least
    every four lengths of the longest piece. Memory depends on the longest piece and on how
    far paths stay apart, not on the text."""
    words, heads, n = v.words, v.heads, len(text)
    best, back = {0: 0.0}, {}  # by end: the score; the piece's start and id
    done, reach, due = 0, 0, 4 * v.longest
    for i in range(n):
        if reach == i > done or i - done >= due:
            live = {e for e in best if e >= i}
            while len(live) > 1:
                live.add(back[e][0]) if (e := max(live)) > done else None
                live.discard(e)
                if min(live) <= done:
                    break
            at = live.pop() if len(live) == 1 else done
            due = 4 * v.longest if at > done else due + 4 * v.longest
            if at > done:
                yield _path(text, back, done, at, v)
                for e in [e for e in back if e <= at]:
                    del back[e]
                done = at
            for e in [e for e in best if e < i]:
                del best[e]
        score = best[i]
        known = False
        for j in range(i + 1, min(n, i + heads.get(text[i], 0)) + 1):
            piece = words.get(text[i:j])
            if piece is not None:
                known |= j == i + 1
                if j not in best or score + piece[1] > best[j]:
                    best[j], back[j] = score + piece[1], (i, piece[0])
                    reach = max(reach, j)
        if not known:
            s = score + v.least - UNKNOWN_PENALTY
            if i + 1 not in best or s > best[i + 1]:
                best[i + 1], back[i + 1] = s, (i, -1)
                reach = max(reach, i + 1)
    if n > done:
        yield _path(text, back, done, n, v)


def _path(text: str, back: dict[int, tuple[int, int]], start: int, end: int, v: Vocabulary) -> list[int]:
    out: list[int] = []
    while end > start:
        i, piece = back[end]
        if piece >= 0:
            out.append(piece)
        elif v.bytes:
            out += [v.bytes[b] for b in reversed(text[i:end].encode("utf-8", "surrogatepass"))]
        elif not (out and out[-1] == v.unknown):  # neighbouring unknown characters are one
            out.append(v.unknown)
        end = i
    return out[::-1]


class _Lookup:
    """Pieces, and all their beginnings, by a hash of their characters, in an open table for
    many stretches at once. id: of a piece, -1 for a mere beginning, -2 for an empty place."""

    STEP = np.uint64(0xD1342543DE82EF95)

    def __init__(self, v: Vocabulary):
        at, hashes = {"": 0}, [0]
        for w in v.words:
            for k in range(1, len(w) + 1):
                if w[:k] not in at:
                    at[w[:k]] = len(hashes)
                    hashes.append((hashes[at[w[: k - 1]]] * int(self.STEP) + int(self.codes(w[k - 1])[0])) % (1 << 64))
        if len(set(hashes)) < len(hashes):
            raise ValueError("two pieces have the same hash")
        size = 1 << (8 * len(hashes)).bit_length()
        self.shift = np.uint64(65 - size.bit_length())
        self.key, self.id, self.score = np.zeros(size + 64, "uint64"), np.full(size + 64, -2, "int32"), np.full(size + 64, -np.inf)
        for w, n in at.items():
            place = hashes[n] >> int(self.shift)
            while self.id[place] != -2:
                place += 1
            self.key[place] = hashes[n]
            self.id[place], self.score[place] = v.words.get(w, (-1, -np.inf))

    @staticmethod
    def codes(text: str) -> np.ndarray:
        return mixed(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "uint32").astype("uint64") + np.uint64(1))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Places in the table; of an empty one where a hash isn't there."""
        at = (h >> self.shift).astype("int64")
        open_ = np.flatnonzero((self.key[at] != h) & (self.id[at] != -2))
        while len(open_):
            at[open_] += 1
            x = at[open_]
            open_ = open_[(self.key[x] != h[open_]) & (self.id[x] != -2)]
        return at


def _stretches(texts: list[str], v: Vocabulary, table: _Lookup) -> dict[str, bytes]:
    """The packed ids of many short stretches: the same search, one character further in all at a time."""
    texts = sorted(texts, key=len, reverse=True)
    size = np.array([len(t) for t in texts])
    m, n = len(texts), int(size[0]) if texts else 0
    codes = np.zeros((n, m), "uint64")
    joined, first = table.codes("".join(texts)), np.cumsum(size) - size
    for i in range(n):
        k = int((size > i).sum())
        codes[i, :k] = joined[first[:k] + i]
    best = np.full((n + 1, m), -np.inf)
    best[0] = 0.0
    start, piece = np.zeros((n + 1, m), "int16"), np.full((n + 1, m), -1, "int32")
    for i in range(n):
        rows = np.arange(int((size > i).sum()))
        h, known = np.zeros(len(rows), "uint64"), np.zeros(len(rows), bool)
        for j in range(i + 1, n + 1):  # while there are pieces that begin like this
            h = h * table.STEP + codes[j - 1, rows]
            at = table.find(h)
            alive = table.id[at] != -2
            rows, h, at = rows[alive], h[alive], at[alive]
            score = best[i, rows] + table.score[at]
            if j == i + 1:
                known[rows[table.id[at] >= 0]] = True
            better = np.flatnonzero(score > best[j, rows])
            r = rows[better]
            best[j, r], start[j, r], piece[j, r] = score[better], i, table.id[at[better]]
            longer = size[rows] > j
            rows, h = rows[longer], h[longer]
            if not len(rows):
                break
        r = np.flatnonzero(~known)
        r = r[best[i, r] + v.least - UNKNOWN_PENALTY > best[i + 1, r]]
        best[i + 1, r], start[i + 1, r], piece[i + 1, r] = best[i, r] + v.least - UNKNOWN_PENALTY, i, -1
    # Backpointers of all stretches at once: ids come last first, a column a step.
    end, row, steps = size.copy(), np.arange(m), []
    while len(row):
        steps.append((row, piece[end[row], row], end[row]))
        end[row] = start[end[row], row]
        row = row[end[row] > 0]
    row, ids, at = (np.concatenate([s[k] for s in steps[::-1]]) for k in range(3)) if steps else (np.zeros(0, "int64"),) * 3
    by_row = np.argsort(row, kind="stable")
    row, ids, at = row[by_row], ids[by_row], at[by_row]
    cut = np.searchsorted(row, np.arange(m + 1))
    raw, odd = ids.astype("<i4").tobytes(), set(row[ids < 0].tolist())
    out = {t: raw[4 * i : 4 * j] for t, i, j in zip(texts, cut[:-1].tolist(), cut[1:].tolist(), strict=True)}
    for r in odd:
        found: list[int] = []
        for x, e in zip(ids[cut[r] : cut[r + 1]].tolist(), at[cut[r] : cut[r + 1]].tolist(), strict=True):
            if x >= 0:
                found.append(x)
            elif v.bytes:
                found += [v.bytes[b] for b in texts[r][e - 1].encode("utf-8", "surrogatepass")]
            elif not (found and found[-1] == v.unknown):
                found.append(v.unknown)
        out[texts[r]] = _packed(found)
    return out


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def encode_all(texts: list[str], v: Vocabulary, cache: dict[str, bytes]) -> list[np.ndarray]:
    """Ids of texts. Where no piece spans a place before a space, all paths meet there, and the
    stretch up to it always has the same ids: short ones are searched together and kept in
    `cache`, long ones are streamed. A vocabulary with other pieces has every text streamed."""
    marked = [normalised(t, v) for t in texts]
    if not v.cuts_at_space:
        return [np.array([i for part in viterbi(t, v) for i in part], "<i4") for t in marked]
    # Where spaces stand alone, each stretch is a space and a word.
    cut = [[SPACE + w for w in t[1:].split(SPACE)] if t.startswith(SPACE) and not t.endswith(SPACE) and SPACE * 2 not in t else _CHUNK.findall(t) for t in marked]
    new = set().union(*cut) - cache.keys()
    if len(cache) + len(new) > CACHED:
        cache.clear()
        new = set().union(*cut)
    long = [c for c in new if len(c) > CACHED_LENGTH]
    if new:
        if v.table is None:
            v.table = _Lookup(v)
        cache.update(_stretches([c for c in new if len(c) <= CACHED_LENGTH], v, v.table))
        cache.update((c, _packed([i for part in viterbi(c, v) for i in part])) for c in long)
    out = [np.frombuffer(b"".join(map(cache.__getitem__, chunks)), "<i4") for chunks in cut]
    for c in long:
        del cache[c]
    return out


def encode(text: str, v: Vocabulary, cache: dict[str, bytes]) -> list[int]:
    """Ids of one text."""
    return encode_all([text], v, cache)[0].tolist()


def decode(ids: np.ndarray | list[int], v: Vocabulary) -> str:
    """The text of ids: byte pieces join to UTF-8 (bad bytes give U+FFFD), control and unknown
    pieces and ids out of range give nothing, and the added first space goes."""
    ids = np.asarray(ids, "int64")
    if len(ids) and (ids.min() < 0 or ids.max() >= len(v.raw)):
        ids = ids[(ids >= 0) & (ids < len(v.raw))]
    text = b"".join(map(v.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text[1:] if v.prefix and text.startswith(" ") else text


def encoded(docs: DataFrame, model: str, text_col: str = "text", into: str = "ids", same: str | None = None) -> DataFrame:
    """docs with the ids of text_col in column `into`, and with `same` given a column that says
    whether decoding gives the text again (existing ones are replaced). The model file is read
    on the driver and its vocabulary broadcast: its size is the file's. Null gives null, an
    empty text no ids. Rows are independent; nothing is shuffled, and a task holds the ids of
    about STEP characters at a time."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model))
    names = [c for c in docs.columns if c not in (into, same)]
    schema = T.StructType([docs.schema[c] for c in names]).add(into, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        cache = _caches.setdefault(hash((len(v.words), v.least, *list(v.words)[:1000])), {})
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col)).to_pylist()
            for lo, hi in in_chunks(texts, STEP):
                found = iter(encode_all([t for t in texts[lo:hi] if t is not None], v, cache))
                ids = [None if t is None else next(found) for t in texts[lo:hi]]
                sizes = [0 if x is None else len(x) for x in ids]
                values = np.concatenate([x for x in ids if x is not None] or [np.zeros(0, "int32")])
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("int32")
                out = [pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()), mask=pa.array([x is None for x in ids]))]
                if same:
                    out.append(pa.array([x is not None and decode(x, v) == t for x, t in zip(ids, texts[lo:hi], strict=True)]))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.names.index(c)) for c in names), *out], [*names, into, *([same] if same else [])])

    return docs.mapInArrow(run, schema.add(same, "boolean") if same else schema)


def decoded(docs: DataFrame, model: str, ids_col: str = "ids", into: str = "text") -> DataFrame:
    """docs with the text of ids_col in column `into`; null gives null."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model))

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = shared.value
        for batch in batches:
            yield pd.Series([None if x is None else decode(x, v) for x in batch], dtype=object)

    return docs.withColumn(into, run(ids_col))


def count(ids: str | Column) -> Column:
    """Number of ids; null for null."""
    return F.when(F.col(ids).isNotNull() if isinstance(ids, str) else ids.isNotNull(), F.size(ids))
