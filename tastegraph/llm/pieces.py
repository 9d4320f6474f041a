"""Operator 10: SentencePiece encoding and decoding.

Unigram Viterbi over a double-array trie of pieces: the segmentation with the largest sum of log
scores. A character that no piece covers costs the lowest score minus 10 and becomes its UTF-8 byte pieces. The
whitespace marker U+2581 stands for a space, one is put before the text, and decoding takes it away
again; a literal U+2581 in a text is written in byte pieces, so every text comes back unchanged.

No piece holds a space after another character (checked when the model is read), so the best path
always breaks before a run of spaces: texts are cut there, and each task remembers the paths of the
stretches it has seen. New short stretches are solved many at a time with numpy over the trie's arrays.

The model file is a parameter; only its pieces and scores, whose size is the vocabulary's, are broadcast.

Defined results: null text gives null ids and null text back; empty text gives no ids. Repeated rows each get
a row, texts of any length are encoded whole, and columns besides the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.text import short_batches

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_PENALTY = 10.0
SHORT = 48  # stretches up to this many bytes are solved together
MEMO = 300_000  # stretches after which a task starts a new generation of remembered paths
STRETCH = re.compile(rb" *[^ ]+| +")


@dataclass
class Pieces:
    """A vocabulary: bytes of each id (None: never matched), scores, ids of the byte pieces."""

    text: list  # bytes of each id when decoded
    score: np.ndarray
    matched: list[int]  # ids that the trie holds
    byte_ids: np.ndarray  # id of the piece of each byte


def read_pieces(model_file: str = MODEL_FILE) -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    text, matched, byte_ids = [], [], np.full(256, -1, np.int32)
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
            text.append(bytes([int(piece[1:-1], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or " " in piece or not piece:
            text.append(b"")
        else:
            text.append(piece.replace(MARKER, " ").encode())
            matched.append(i)
    score = np.array([sp.get_score(i) for i in range(len(text))])
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary has no byte pieces")
    if any(re.search(rb"[^ ] ", text[i]) for i in matched):
        raise ValueError("a piece holds a space after another character")
    return Pieces(text, score, matched, byte_ids)


class DoubleArray:
    """Double-array trie: the child of state s by byte b is t = base[s] + b when check[t] == s."""

    def __init__(self, keys: dict[bytes, int]):
        root: dict = {}
        for key, value in keys.items():
            node = root
            for b in key:
                node = node.setdefault(b, {})
            node[-1] = value
        span = 2048  # places tried at once
        size = 1 << 16
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken = np.zeros(size, bool)
        taken[0], free, tail = True, 1, 1  # first free slot; where families of several look first
        todo = [(0, root)]
        while todo:
            state, node = todo.pop()
            value[state] = node.pop(-1, -1)
            if not node:
                continue
            labels = sorted(node)
            at = max(1, (free if len(labels) == 1 else max(free, tail)) - labels[0])
            while True:
                if at + span + 256 >= size:
                    base, check, value, taken = (
                        np.r_[x, np.full(size, fill, x.dtype)]
                        for x, fill in ((base, 0), (check, -1), (value, -1), (taken, False))
                    )
                    size *= 2
                busy = taken[at + labels[0] : at + labels[0] + span].copy()
                for b in labels[1:]:
                    busy |= taken[at + b : at + b + span]
                if not busy.all():
                    at += int(busy.argmin())
                    break
                at += span
                tail = at  # the slots before are crowded
            base[state] = at
            for b in labels:
                taken[at + b] = True
                check[at + b] = state
                todo.append((at + b, node[b]))
            while taken[free]:
                free += 1
        self.base, self.check, self.value = base, check, value


def _char_bytes(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


def _packed(ids: list[int]) -> bytes:
    """Ids as 32-bit integers, so that a text's are joined a stretch at a time and not id by id."""
    return array("i", ids).tobytes()


class Encoder:
    def __init__(self, pieces: Pieces, trie: DoubleArray):
        self.p, self.trie, self.memo, self.old = pieces, trie, {}, {}
        self.unknown = float(pieces.score[pieces.matched].min()) - UNKNOWN_PENALTY
        # Plain lists are faster than arrays for one step at a time.
        self.lists = None

    def _ids(self, stretch: bytes, back: list[int], piece: list[int]) -> list[int]:
        """Ids along the best path, followed from its end."""
        out, at = [], len(stretch)
        while at > 0:
            start = back[at]
            if piece[at] >= 0:
                out.append(piece[at])
            else:
                out.extend(self.p.byte_ids[list(stretch[start:at])].tolist()[::-1])
            at = start
        out.reverse()
        return out

    def one(self, s: bytes) -> list[int]:
        """Viterbi along one stretch; of equal scores the path found first (earlier start) stays."""
        if self.lists is None:
            t = self.trie
            self.lists = [x.tolist() for x in (t.base, t.check, t.value, self.p.score)]
        base, check, value, score = self.lists
        n = len(s)
        best = np.full(n + 1, -np.inf)
        start, piece = np.zeros(n + 1, np.int64), np.full(n + 1, -1, np.int32)
        best[0] = 0.0
        i = 0
        while i < n:
            here, wide, state = float(best[i]), _char_bytes(s[i]), 0
            single = False
            for j in range(i, n):
                t = base[state] + s[j]
                if check[t] != state:
                    break
                state = t
                v = value[state]
                if v >= 0:
                    single = single or j + 1 == i + wide
                    x = here + score[v]
                    if x > best[j + 1]:
                        best[j + 1], start[j + 1], piece[j + 1] = x, i, v
            if not single and here + self.unknown > best[i + wide]:
                best[i + wide], start[i + wide], piece[i + wide] = here + self.unknown, i, -1
            i += wide
        return self._ids(s, start.tolist(), piece.tolist())

    def many(self, stretches: list[bytes]) -> list[list[int]]:
        """The same for many short stretches at once."""
        t, score = self.trie, self.p.score
        n = len(stretches)
        size = np.array([len(s) for s in stretches])
        wide = int(size.max())
        m = np.frombuffer(b"".join(s.ljust(wide + 1, b"\0") for s in stretches), np.uint8).reshape(n, wide + 1)
        best = np.full((n, wide + 5), -np.inf)
        start, piece = np.zeros((n, wide + 5), np.int16), np.full((n, wide + 5), -1, np.int32)
        best[:, 0] = 0.0
        char = np.select([m < 0x80, m < 0xE0, m < 0xF0], [1, 2, 3], 4)
        is_start = (m & 0xC0) != 0x80
        for i in range(wide):
            rows = np.flatnonzero((size > i) & is_start[:, i])
            here, chars = best[rows, i], char[rows, i]
            single = np.zeros(len(rows), bool)
            at, state = np.arange(len(rows)), np.zeros(len(rows), np.int32)
            for j in range(i, wide):
                keep = size[rows[at]] > j
                at, state = at[keep], state[keep]
                nxt = t.base[state] + m[rows[at], j]
                keep = t.check[nxt] == state
                at, state = at[keep], nxt[keep]
                if not len(at):
                    break
                v = t.value[state]
                ok = v >= 0
                who, v = at[ok], v[ok]
                single[who[chars[who] == j + 1 - i]] = True
                x = here[who] + score[v]
                better = x > best[rows[who], j + 1]
                r = rows[who[better]]
                best[r, j + 1], start[r, j + 1], piece[r, j + 1] = x[better], i, v[better]
            lone = np.flatnonzero(~single)
            r, end = rows[lone], i + chars[lone]
            x = here[lone] + self.unknown
            better = x > best[r, end]
            r, end = r[better], end[better]
            best[r, end], start[r, end], piece[r, end] = x[better], i, -1
        return list(map(self._ids, stretches, start.tolist(), piece.tolist()))

    def texts(self, texts: list[str | None]) -> list[np.ndarray | None]:
        cut = [None if t is None else STRETCH.findall(b" " + t.encode()) if t else [] for t in texts]
        if len(self.memo) > MEMO:  # what is still in use moves over from the old generation
            self.memo, self.old = {}, self.memo
        memo, old = self.memo, self.old
        new = set().union(*(c for c in cut if c)).difference(memo)
        again = new.intersection(old)
        memo.update((s, old[s]) for s in again)
        new -= again
        short = sorted((s for s in new if len(s) <= SHORT), key=len)
        for a in range(0, len(short), 4096):
            part = short[a : a + 4096]
            memo.update(zip(part, map(_packed, self.many(part))))
        for s in new:
            if len(s) > SHORT:
                memo[s] = _packed(self.one(s))
        return [None if c is None else np.frombuffer(b"".join(map(memo.__getitem__, c)), np.int32) for c in cut]


def _list_array(rows: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if r is None else len(r) for r in rows]
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    values = np.concatenate([r for r in rows if r is not None] or [np.zeros(0, np.int32)])
    mask = pa.array([r is None for r in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()), mask=mask)


def _slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about ``most`` bytes, so that a task holds few texts as Python objects."""
    step = max(1, int(batch.num_rows * most / max(1, batch.column(column).nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def encode(
    documents: DataFrame, model_file: str = MODEL_FILE, text_col: str = "text", keep: tuple[str, ...] = ("doc_id", "text")
) -> DataFrame:
    """The ``keep`` columns and ids array<int> of every row."""
    pieces = read_pieces(model_file)
    trie = DoubleArray({pieces.text[i]: i for i in pieces.matched})
    shared = documents.sparkSession.sparkContext.broadcast((pieces, trie))  # a vocabulary
    kinds = {f.name: f.dataType.simpleString() for f in documents.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for whole in batches:
            for batch in _slices(whole, "_text"):
                ids = _list_array(encoder.texts(batch.column("_text").to_pylist()))
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), ids], names=[*keep, "ids"])

    rows = short_batches(documents).select(*keep, F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, ", ".join([*(f"{k} {kinds[k]}" for k in keep), "ids array<int>"]))


def decode_ids(ids: np.ndarray, text: list[bytes]) -> str:
    """The text of some ids; bytes that are not UTF-8 become U+FFFD."""
    data = b"".join([text[i] for i in ids.tolist()])
    return data.removeprefix(b" ").decode("utf-8", "replace")


def decode(encoded: DataFrame, model_file: str = MODEL_FILE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(``keep`` columns, decoded text) of rows with ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_pieces(model_file).text)
    kinds = {f.name: f.dataType.simpleString() for f in encoded.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = shared.value
        for batch in batches:
            lists = batch.column("ids")
            out = [
                decode_ids(lists[i].values.to_numpy(), text) if lists[i].is_valid else None
                for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(out, pa.string())], names=[*keep, "decoded"]
            )

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keep), "decoded string"])
    return encoded.select(*keep, "ids").mapInArrow(run, schema)


def digests(encoded: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """(doc_id, n_pieces, n_byte_pieces, ids_sha256, round_trip) of encoded rows: the digest covers the ids as
    little-endian 32-bit integers, ``round_trip`` says that decoding them gives the text back."""
    pieces = read_pieces(model_file)
    shared = encoded.sparkSession.sparkContext.broadcast((pieces.text, pieces.byte_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, byte_ids = shared.value
        is_byte = np.zeros(len(text), bool)
        is_byte[byte_ids] = True
        for batch in batches:
            rows = []
            for i, t in enumerate(batch.column("text").to_pylist()):
                cell = batch.column("ids")[i]
                ids = cell.values.to_numpy() if cell.is_valid else np.zeros(0, np.int32)
                same = not cell.is_valid if t is None else decode_ids(ids, text) == t
                digest = hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest()
                rows.append((len(ids), int(is_byte[ids].sum()), digest, same))
            n, b, d, same = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(b, pa.int64()),
                    pa.array(d, pa.string()), pa.array(same, pa.bool_()),
                ],
                names=["doc_id", "n_pieces", "n_byte_pieces", "ids_sha256", "round_trip"],
            )

    schema = "doc_id long, n_pieces long, n_byte_pieces long, ids_sha256 string, round_trip boolean"
    return encoded.select("doc_id", "text", "ids").mapInArrow(run, schema)
