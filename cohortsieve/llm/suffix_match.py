"""Operator 5, SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct pre-tokens are concatenated and indexed with a suffix array; a binary search, all pieces
side by side, gives the range of places where each piece occurs. The places are edges; they are sorted
by where they end and relaxed from left to right. The vocabulary is a BPE one, so an edge is not weighed by
a score: a sequence of pieces is the library's encoding exactly if every two neighbours, put together, are
encoded as those two. Each prefix of a pre-token has one encoding, hence one edge into each place survives
the relaxation, and it names the last piece there. Which pairs stand is asked of the library once per
pair and kept. Characters outside the vocabulary become byte tokens.

Scale: map passes without a shuffle. A worker holds one Arrow batch, the index over that batch's distinct
pre-tokens in runs of at most ``INDEX_CHARS`` characters, and bounded memos.

Defined cases: a NULL or empty text has no tokens, and decodes to the empty text. Texts are read whole.
Repeated rows are encoded alike, an empty table gives no rows. All columns stay; an output name that is taken gets
underscores appended. Decoding turns an invalid byte into U+FFFD, an unknown token into " U+2047 ", and gives
control tokens no text, as the library does; ids outside the vocabulary are an error; NULL ids decode to the empty text.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cohortsieve.llm.pieces import SPACE, Pieces, broadcast_model, loaded, pretokens
from cohortsieve.llm.registry import query
from cohortsieve.llm.texts import free_name, table, text_of

#: Characters indexed at once; longer runs of pre-tokens take several indexes, and no pre-token is cut.
INDEX_CHARS = 200_000
#: Texts taken together; a longer text is taken alone.
TEXT_CHARS = 500_000
MEMO, MEMO_CHARS, PAIR_MEMO = 200_000, 64, 500_000
#: Stands between pre-tokens; above every Unicode character.
GAP = 0x110000
UNKNOWN = -1


def packed(codes: np.ndarray, size: int, depth: int) -> tuple[list[np.ndarray], int]:
    """The ``depth`` codes from each place on, as sort keys of 64 bits, and how many codes a key holds."""
    bits = max(1, int(size).bit_length())
    per = 64 // bits
    padded = np.concatenate((codes, np.zeros(depth + per, np.int64))).astype(np.uint64)
    keys = []
    for first in range(0, depth, per):
        key = np.zeros(len(codes), np.uint64)
        for i in range(first, first + per):
            key = (key << np.uint64(bits)) | padded[i:i + len(codes)]
        keys.append(key)
    return keys, per


class Matcher:
    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        texts = [pieces.piece[i] for i in pieces.normal]
        self.ids = np.array(pieces.normal)
        self.length = np.array([len(t) for t in texts])
        self.depth = int(self.length.max())
        self.rows = np.zeros((len(texts), self.depth), np.int64)
        for i, t in enumerate(texts):
            self.rows[i, :len(t)] = [ord(c) for c in t]
        self.known: dict[str, bytes] = {}
        self._forget_pairs()

    def _forget_pairs(self) -> None:
        self.pairs, self.stands = np.zeros(0, np.int64), np.zeros(0, bool)

    # --- matching

    def _edges(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, id) of every occurrence of every piece."""
        alphabet, codes = np.unique(chars, return_inverse=True)
        keys, per = packed(codes + 1, len(alphabet) + 1, self.depth)
        order = np.lexsort(keys[::-1])
        # Pieces with a character that the text lacks occur nowhere.
        inside = np.arange(self.depth) < self.length[:, None]
        at = np.minimum(np.searchsorted(alphabet, self.rows), len(alphabet) - 1)
        which = np.flatnonzero(((alphabet[at] == self.rows) | ~inside).all(1))
        rows, length = np.where(inside, at + 1, 0)[which], self.length[which]
        first, last = self._first_key(keys[0][order], rows, length, per, len(alphabet) + 1)
        long = np.flatnonzero((length > per) & (first < last))
        if len(long):
            padded = np.concatenate((codes + 1, np.zeros(self.depth, np.int64)))
            first[long], last[long] = (self._search(padded, order, rows[long], length[long], first[long], last[long], after)
                                       for after in (False, True))
        n = np.maximum(last - first, 0)
        hit = np.repeat(np.arange(len(n)), n)
        start = order[first[hit] + np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n)]
        return start, start + length[hit], self.ids[which[hit]]

    @staticmethod
    def _first_key(sorted_keys: np.ndarray, rows: np.ndarray, length: np.ndarray, per: int, size: int):
        """The range of places whose first key begins with each piece (or its first ``per`` characters)."""
        bits = max(1, int(size).bit_length())
        low = np.zeros(len(rows), np.uint64)
        for i in range(per):
            low = (low << np.uint64(bits)) | (rows[:, i].astype(np.uint64) if i < rows.shape[1] else np.uint64(0))
        free = (bits * np.maximum(per - length, 0)).astype(np.uint64)
        high = low | ((np.uint64(1) << free) - np.uint64(1))
        return np.searchsorted(sorted_keys, low), np.searchsorted(sorted_keys, high, side="right")

    def _search(self, padded, order, rows, length, low, high, after: bool) -> np.ndarray:
        """A binary search side by side, within the ranges of the first key, for pieces longer than it."""
        columns = np.arange(self.depth)
        inside = columns < length[:, None]
        low, high, i = low.copy(), high.copy(), np.arange(len(rows))
        while (open_ := low < high).any():
            middle = (low + high) // 2
            window = padded[order[np.minimum(middle, len(order) - 1)][:, None] + columns]
            differs = (window != rows) & inside
            at = differs.argmax(1)
            sign = np.where(differs.any(1), np.sign(window[i, at] - rows[i, at]), 0)
            below = (sign <= 0) if after else (sign < 0)
            low = np.where(open_ & below, middle + 1, low)
            high = np.where(open_ & ~below, middle, high)
        return low

    def _stand(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the library encodes the two pieces together as those two."""
        size = len(self.pieces.piece)
        codes, where = np.unique(left * size + right, return_inverse=True)
        at = np.searchsorted(self.pairs, codes)
        new = np.ones(len(codes), bool)
        if len(self.pairs):
            new = self.pairs[np.minimum(at, len(self.pairs) - 1)] != codes
        if new.any():
            asked = codes[new]
            piece = self.pieces.piece
            # A line feed is a byte token here, which nothing merges with: the pair starts after it.
            answers = self.pieces.sp.encode(
                ["\n" + (piece[c // size] + piece[c % size]).replace(SPACE, " ") for c in asked.tolist()], num_threads=1)
            good = np.array([a[2:] == [c // size, c % size] for a, c in zip(answers, asked.tolist())])
            if len(self.pairs) + len(asked) > PAIR_MEMO:
                keep = np.isin(self.pairs, codes)
                self.pairs, self.stands = self.pairs[keep], self.stands[keep]
            pairs, stands = np.concatenate((self.pairs, asked)), np.concatenate((self.stands, good))
            by = np.argsort(pairs, kind="stable")
            self.pairs, self.stands = pairs[by], stands[by]
            at = np.searchsorted(self.pairs, codes)
        return self.stands[at][where]

    def _encode_new(self, pre: list[str]) -> list[bytes]:
        """The ids, 32 bits each, of pre-tokens (without their first space), by one index over all of them."""
        texts = [SPACE + p.replace(" ", SPACE) for p in pre]
        joined = "".join(t + "\0" for t in texts)
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array([len(t) for t in texts])
        begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        ends = begins + sizes
        chars[ends] = GAP
        start, end, token = self._edges(chars)
        # A character that no piece consists of is an edge of its own.
        seen = np.zeros(len(chars) + 1, bool)
        seen[start[end - start == 1]] = True
        seen[ends] = True
        lone = np.flatnonzero(~seen[:len(chars)])
        start, end = np.concatenate((start, lone)), np.concatenate((end, lone + 1))
        token = np.concatenate((token, np.full(len(lone), UNKNOWN)))

        word = np.repeat(begins, sizes + 1)
        reach = end - word[start]
        by = np.argsort(reach.astype(np.uint16) if reach.max() < 1 << 16 else reach, kind="stable")
        start, end, token, reach = start[by], end[by], token[by], reach[by]
        cuts = np.searchsorted(reach, np.arange(1, int(sizes.max()) + 2))
        last, before = np.full(len(chars), -2), np.full(len(chars), -1)
        first = np.zeros(len(chars), bool)
        first[begins] = True
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if a == b:
                continue
            s, e, t = start[a:b], end[a:b], token[a:b]
            left = last[s]
            good = first[s] | (left == UNKNOWN) | ((t == UNKNOWN) & (left != -2))
            ask = np.flatnonzero(~good & (left >= 0))
            if len(ask):
                good[ask] = self._stand(left[ask], t[ask])
            last[e[good]], before[e[good]] = t[good], s[good]

        found_word, found_at, found = [], [], []
        alive, place = np.arange(len(texts)), ends.copy()
        while len(alive):
            found_word.append(alive)
            found_at.append(place)
            found.append(last[place])
            place = before[place]
            going = place > begins[alive]
            alive, place = alive[going], place[going]
        w, p, t = map(np.concatenate, (found_word, found_at, found))
        by = np.lexsort((p, w))
        w, p, t = w[by], p[by], t[by]
        limits = np.searchsorted(w, np.arange(len(texts) + 1)).tolist()
        unknown = set(w[t == UNKNOWN].tolist())
        buffer = t.astype(np.int32).tobytes()
        out = []
        for i in range(len(texts)):
            a, b = limits[i], limits[i + 1]
            if i in unknown:
                ids = chain.from_iterable([x] if x != UNKNOWN else [self.pieces.byte_id[c] for c in joined[q - 1].encode()]
                                          for x, q in zip(t[a:b].tolist(), p[a:b].tolist()))
                out.append(np.fromiter(ids, np.int32).tobytes())
            else:
                out.append(buffer[4 * a:4 * b])
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids, 32 bits each."""
        cut = [pretokens(t or "") for t in texts]
        new = [p for p in set(chain.from_iterable(cut)) if p not in self.known]
        local: dict[str, bytes] = {}
        run, size = [], 0
        for p in new:
            run.append(p)
            size += len(p) + 2
            if size >= INDEX_CHARS:
                local.update(zip(run, self._encode_new(run)))
                run, size = [], 0
        if run:
            local.update(zip(run, self._encode_new(run)))
        known = self.known
        if len(known) + len(local) > MEMO:
            local.update((p, known[p]) for pre in cut for p in pre if p in known)
            known.clear()
        known.update(local)
        out = [b"".join(map(known.__getitem__, pre)) for pre in cut]
        for p in [p for p in local if len(p) > MEMO_CHARS]:
            del known[p]
        return out


def _one_by_one(error: UnicodeError):
    return "�", error.start + 1


codecs.register_error("replace-each-byte", _one_by_one)


class Decoder:
    def __init__(self, pieces: Pieces):
        normal = set(pieces.normal)
        bytes_ = {i: b for b, i in pieces.byte_id.items()}
        self.table = [
            bytes([bytes_[i]]) if i in bytes_ else p.replace(SPACE, " ").encode() if i in normal
            else b"" if pieces.sp.is_control(i) else " ⁇ ".encode()
            for i, p in enumerate(pieces.piece)]
        self.leads = [i in normal and p.startswith(SPACE) for i, p in enumerate(pieces.piece)]
        self.silent = [not b for b in self.table]

    def decode_all(self, ids: pa.ListArray) -> Iterator[str]:
        """The texts of an Arrow column of ids."""
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        sizes = pa.compute.fill_null(pa.compute.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        return (self.decode(flat[end - size:end].tolist()) for end, size in zip(ends.tolist(), sizes.tolist()))

    def decode(self, ids: list[int] | None) -> str:
        """The text; the space that encoding puts before the first token goes."""
        if not ids:
            return ""
        if min(ids) < 0:
            raise ValueError("an id outside the vocabulary")
        text = b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace-each-byte")
        first = next((i for i in ids if not self.silent[i]), None)
        return text[1:] if first is not None and self.leads[first] else text


_TOOLS: dict[tuple[int, type], Matcher | Decoder] = {}


def _tool(kind: type, pieces: Pieces):
    if (id(pieces), kind) not in _TOOLS:
        _TOOLS[id(pieces), kind] = kind(pieces)
    return _TOOLS[id(pieces), kind]


def _slices(batch: pa.RecordBatch, name: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows, cut where a column's bytes or elements reach ``most``; no row is cut."""
    column = batch.column(name)
    count = pa.compute.list_value_length if pa.types.is_list(column.type) else pa.compute.binary_length
    sizes = np.cumsum(pa.compute.fill_null(count(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.searchsorted(sizes, np.arange(most, sizes[-1] if len(sizes) else 0, most)) + 1
    start = 0
    for cut in np.unique(np.append(cuts, len(column))).tolist():
        if cut > start:
            yield batch.slice(start, cut - start)
            start = cut


def _lists(rows: list[bytes]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(r) // 4 for r in rows], dtype=np.int64)))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def encode(docs: DataFrame, model: Broadcast, text: str = "text", out: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of ``text`` in one more column."""
    name = free_name(docs, out)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _tool(Matcher, loaded(model.value))
        for b in (part for whole in batches for part in _slices(whole, text, TEXT_CHARS)):
            ids = _lists(matcher.encode(b.column(text).to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns, ids], [*b.schema.names, name])

    return docs.mapInArrow(per_batch, schema)


def decode(docs: DataFrame, model: Broadcast, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids`` in one more column."""
    name = free_name(docs, out)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())])

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _tool(Decoder, loaded(model.value))
        for b in (part for whole in batches for part in _slices(whole, ids, TEXT_CHARS)):
            texts = pa.array(decoder.decode_all(b.column(ids)), pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, texts], [*b.schema.names, name])

    return docs.mapInArrow(per_batch, schema)


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, the ids of the whole text, their number, and whether decoding gives the text again."""
    model = broadcast_model(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text", F.xxhash64(text_of()).alias("hash"))
    both = decode(encode(docs, model).drop("text"), model)
    return both.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                       (F.xxhash64("decoded") == F.col("hash")).alias("round_trip"))
