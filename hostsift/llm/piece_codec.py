"""SentencePiece encoding with seeded merge-dropout, and decoding.

Encoding follows the model's merge order by an agenda: the candidate merge with the best
score comes off first.  With dropout each candidate is skipped where a keyed hash of
(seed, document id, the unit's place, the candidate's place and sizes) falls under the
rate, so the same seed always gives the same ids, and each occurrence of a word is cut
on its own, all decoding to the same text.  A skipped merge is gone
for good; a candidate that later merges make is a new one.

A unit is a run of spaces with the run of other characters behind it; no piece of the model
spans two units (checked when the model is loaded), so units are encoded on their own.  All
units of a batch run their agendas side by side: in each round every unit takes or skips its
best candidate, in arrays of one column a unit.  Units of more than ``SHORT`` characters
have an agenda each, with a heap.

Round trip: decode(encode(text)) == text for every text, since characters without a piece
go to byte pieces and white space is never changed.  Nulls and odd input: a null text has
null ids and decodes to null; an empty text has no ids; null ids share one key; a
repeated row gets equal ids; an empty table gives an empty result; other columns pass
through where names do not clash with the output's.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
#: Stands for a "▁" of the text itself, which must not be read back as a space; no text holds it.
LITERAL = "\udc81"
#: Units of up to so many characters run side by side, in arrays of these heights.
SHORT = 64
HEIGHTS = (8, 16, 32, SHORT)
#: Characters encoded together; a longer text is a batch of its own.
AT_ONCE = 1_000_000
#: Units that run side by side at most.
UNITS = 1 << 15
_NONE = np.int64(1 << 62)


_MASK = (1 << 64) - 1
_STEP, _M1, _M2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
#: A candidate's code is the sum of its place and its two sizes by these factors.
_PLACE, _LEFT, _RIGHT = 0xD1B54A32D192ED03, 0xABC98388FB8FAC03, 0x8CB92BA72F3D8DD7


def document_key(doc, seed: int) -> int:
    """The keyed hash of a document's id."""
    name = "" if doc is None else str(doc)
    return int.from_bytes(hashlib.blake2b(name.encode(), key=str(seed).encode()[:64], digest_size=8).digest(), "little")


def mixed(x: int) -> int:
    x = ((x ^ x >> 30) * _M1) & _MASK
    x = ((x ^ x >> 27) * _M2) & _MASK
    return x ^ x >> 31


def _mixed(x: np.ndarray) -> np.ndarray:
    """The same for an array of 64-bit numbers, in place."""
    for shift, factor in ((30, _M1), (27, _M2)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def marked(text: str) -> str:
    """The text with the model's dummy space in front and its marks for spaces."""
    return (" " + text).replace(SPACE, LITERAL).replace(" ", SPACE)


class PieceModel:
    """Pieces, scores and byte pieces of a BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids, self.rank, self.bytes = {}, {}, [0] * 256
        self.texts: list[bytes] = []
        for k in range(m.get_piece_size()):
            piece = m.id_to_piece(k)
            if m.is_byte(k):
                self.bytes[int(piece[3:5], 16)] = k
                self.texts.append(bytes([int(piece[3:5], 16)]))
            elif m.is_control(k) or m.is_unknown(k):
                self.texts.append(b"")
            else:
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError(f"piece {piece!r} spans units")
                self.ids[piece] = k
                self.rank[piece] = -m.get_score(k)
                self.texts.append(piece.replace(SPACE, " ").encode())
        # Symbols are pieces by their ids and, from there on, characters that are no piece.
        self.symbols = dict(self.ids)
        self.spelled = [[k] for k in range(len(self.texts))]
        # Merges: pairs of symbols by what they make, as rank; each rank is one piece.
        order = sorted(self.ids, key=self.rank.get)
        self.made = np.array([self.ids[piece] for piece in order], np.int64)
        pairs = {}
        for rank, piece in enumerate(order):
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if (left in self.ids or cut == 1) and (right in self.ids or cut == len(piece) - 1):
                    pairs[self.symbol(left) << 22 | self.symbol(right)] = rank
        self.pairs = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in sorted(pairs)], np.int64)

    def symbol(self, text: str) -> int:
        if text not in self.symbols:
            self.symbols[text] = len(self.spelled)
            self.spelled.append([self.bytes[b] for b in (SPACE if text == LITERAL else text).encode("utf-8", "replace")])
        return self.symbols[text]

    def candidate(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank and place of the merge of two symbols in one number; ``_NONE`` where there is none."""
        pair = left << 22 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ranks[at] << 8 | place, _NONE)

    def unit(self, unit: str, bar: int = 0, key: int = 0) -> list[int]:
        """Ids of one unit (spaces as the model's mark); candidates whose hash under ``key`` falls below ``bar`` (of 32 bits) are skipped."""
        return [k for piece in self._long(unit, bar, key) for k in self.spelled[self.symbol(piece)]]

    def _side_by_side(self, flat: np.ndarray, first: np.ndarray, size: np.ndarray, keys: np.ndarray, bar: int) -> None:
        """Runs the agendas of units of ``size`` symbols from ``first``; ``flat`` keeps each unit's pieces at their places, -1 between them."""
        height = int(size.max())
        place = np.arange(height)[:, None]
        at = np.minimum(first + place, len(flat) - 1)
        inside = place < size
        ids, long, before = np.where(inside, flat[at], -1), inside.astype(np.int64), place - np.ones_like(size)
        agenda = np.full((height, len(size)), _NONE)
        if height > 1:
            agenda[:-1] = np.where(inside[1:], self.candidate(ids[:-1], ids[1:], place[:-1]), _NONE)
        unit = np.arange(len(size))  # the agenda's columns; columns without candidates are dropped now and then
        while True:
            best = agenda.min(axis=0)
            col = np.flatnonzero(best < _NONE)
            if not len(col):
                break
            if 2 * len(col) < len(unit):
                agenda, unit, best = agenda[:, col], unit[col], best[col]
                col = np.arange(len(unit))
            else:
                best = best[col]
            u, k, rank = unit[col], best & 255, best >> 8
            a = long[k, u]
            b = long[k + a, u]
            if bar:
                code = k.astype(np.uint64) * np.uint64(_PLACE) + a.astype(np.uint64) * np.uint64(_LEFT) + b.astype(np.uint64) * np.uint64(_RIGHT)
                skipped = _mixed(keys[u] + code) >> np.uint64(32) < bar
                agenda[k[skipped], col[skipped]] = _NONE
                taken = ~skipped
                u, k, rank, a, b, col = (x[taken] for x in (u, k, rank, a, b, col))
            ids[k, u] = self.made[rank]
            long[k, u] = a + b
            long[k + a, u] = 0
            agenda[k + a, col] = _NONE
            after = k + a + b
            agenda[k, col] = _NONE
            more = np.flatnonzero(after < size[u])
            before[after[more], u[more]] = k[more]
            agenda[k[more], col[more]] = self.candidate(ids[k[more], u[more]], ids[after[more], u[more]], k[more])
            left = before[k, u]
            more = np.flatnonzero(left >= 0)
            agenda[left[more], col[more]] = self.candidate(ids[left[more], u[more]], ids[k[more], u[more]], left[more])
        flat[at[inside]] = np.where(long > 0, ids, -1)[inside]

    def _long(self, unit: str, bar: int, key: int) -> list[str]:
        """Pieces of one unit, its agenda in a heap."""
        n, rank = len(unit), self.rank
        after, before, size = list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n
        agenda: list[tuple[float, int, int, int]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < n:
                r = rank.get(unit[left : right + size[right]])
                if r is not None:
                    heapq.heappush(agenda, (r, left, size[left], size[right]))

        for k in range(n - 1):
            offer(k)
        while agenda:
            _, left, a, b = heapq.heappop(agenda)
            right = left + a
            if size[left] != a or right >= n or size[right] != b:
                continue
            if bar and mixed((key + left * _PLACE + a * _LEFT + b * _RIGHT) & _MASK) >> 32 < bar:
                continue
            size[left], size[right] = a + b, 0
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        out, k = [], 0
        while k < n:
            out.append(unit[k : k + size[k]])
            k += size[k]
        return out

    def encode(self, text: str, rate: float = 0.0, seed: int = 0, doc=None) -> np.ndarray:
        """Ids of one text."""
        return self.encode_all([text], [doc], rate, seed)[0]

    def encode_all(self, texts: list[str], docs: list, rate: float = 0.0, seed: int = 0) -> list[np.ndarray]:
        """Ids of each text."""
        out, low, held = [], 0, 0
        for k, text in enumerate(texts):
            if k > low and held + len(text) > AT_ONCE:
                out += self._encode_some(texts[low:k], docs[low:k], rate, seed)
                low, held = k, 0
            held += len(text)
        return out + self._encode_some(texts[low:], docs[low:], rate, seed)

    def _encode_some(self, texts: list[str], docs: list, rate: float, seed: int) -> list[np.ndarray]:
        full = [marked(t) if t else "" for t in texts]
        points = np.frombuffer("".join(full).encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.cumsum([len(t) for t in full])
        if not len(points):
            return [np.zeros(0, np.uint32) for _ in texts]
        letters, which = np.unique(points, return_inverse=True)
        flat = np.array([self.symbol(chr(c)) for c in letters.tolist()], np.int64)[which]
        space = points == ord(SPACE)
        opens = space.copy()
        opens[1:] &= ~space[:-1]
        begins = (ends - [len(t) for t in full])[[bool(t) for t in full]]
        opens[begins] = True
        first = np.flatnonzero(opens)
        size = np.diff(np.append(first, len(points)))
        bar = int(rate * (1 << 32))
        text_of = np.searchsorted(ends, first, side="right")
        number = np.arange(len(first)) - np.searchsorted(first, first[np.searchsorted(first, begins)])[np.searchsorted(begins, first, side="right") - 1]
        named = np.array([document_key(d, seed) if bar else 0 for d in docs], np.uint64)
        keys = _mixed((number + 1).astype(np.uint64) * np.uint64(_STEP) + named[text_of])
        low = 0
        for high in HEIGHTS:
            units = np.flatnonzero((size > low) & (size <= high))
            for at in range(0, len(units), UNITS):
                own = units[at : at + UNITS]
                self._side_by_side(flat, first[own], size[own], keys[own], bar)
            low = high
        joined = "".join(full) if (size > SHORT).any() else ""
        for k in np.flatnonzero(size > SHORT).tolist():
            at = int(first[k])
            pieces = self._long(joined[at : at + int(size[k])], bar, int(keys[k]))
            flat[at : at + int(size[k])] = -1
            for piece in pieces:
                flat[at] = self.symbol(piece)
                at += len(piece)
        kept = flat >= 0
        symbols, cuts = flat[kept], np.cumsum(kept)[ends - 1]
        cuts = np.where(ends > 0, cuts, 0)
        spelled = symbols >= len(self.texts)
        if spelled.any():  # characters that are no piece, as their bytes
            counts = np.ones(len(symbols), np.int64)
            counts[spelled] = [len(self.spelled[k]) for k in symbols[spelled].tolist()]
            total = np.concatenate([[0], np.cumsum(counts)])
            made = np.repeat(symbols, counts)
            for k in np.flatnonzero(spelled).tolist():
                made[total[k] : total[k + 1]] = self.spelled[symbols[k]]
            symbols, cuts = made, total[cuts]
        return np.split(symbols.astype("<u4"), cuts[:-1])

    def decode(self, ids) -> str:
        return b"".join(map(self.texts.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids)).decode("utf-8", "replace")[1:]


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode_pieces(
    docs: DataFrame, path: str, rate: float = 0.1, seed: int = 0,
    id_col: str = "doc_id", text_col: str = "text", ids_col: str = "ids",
) -> DataFrame:
    """The documents with ``ids_col``, an array of piece ids."""
    kept = [f for f in docs.schema.fields if f.name != ids_col]
    schema = T.StructType([*kept, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = model(path).encode_all
        for batch in batches:
            texts = batch[text_col].to_pylist()
            ids = encode_all([t or "" for t in texts], batch[id_col].to_pylist(), rate, seed)
            made = [None if t is None else i.astype(np.int32) for t, i in zip(texts, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch[f.name] for f in kept), pa.array(made, pa.list_(pa.int32()))], schema.names)

    return docs.mapInArrow(run, schema)


def decode_pieces(encoded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The rows with ``text_col`` decoded from ``ids_col``."""
    kept = [f for f in encoded.schema.fields if f.name != text_col]
    schema = T.StructType([*kept, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = model(path).decode
        for batch in batches:
            made = [None if ids is None else decode(ids) for ids in batch[ids_col].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[f.name] for f in kept), pa.array(made, pa.string())], schema.names)

    return encoded.mapInArrow(run, schema)


def piece_report(docs: DataFrame, path: str, rate: float = 0.1, seed: int = 0) -> DataFrame:
    """One row a document: doc_id, n_pieces, ids_sha256 (of the little-endian 32-bit ids), restored (the ids decode to the text).

    Encodes and decodes in one pass, so the ids of a document are dropped once they are told.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = model(path)
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            made = codec.encode_all(texts, batch["doc_id"].to_pylist(), rate, seed)
            rows = [(len(i), hashlib.sha256(i.tobytes()).hexdigest(), codec.decode(i) == t) for i, t in zip(made, texts, strict=True)]
            made = map(pa.array, zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *made], ["doc_id", "n_pieces", "ids_sha256", "restored"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_pieces long, ids_sha256 string, restored boolean")
