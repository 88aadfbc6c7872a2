"""Operator 1, token counts by the whole-token shortcut.

No piece of the vocabulary holds a space after another character (``Pieces`` checks this), so a text's
tokens are those of its pre-tokens. Before any text is read, each piece that looks like a pre-token is
encoded alone; those that come back as one token are whole. Pre-tokens among them count one; only the
rest are merged, once per distinct string and worker while they stay in a bounded memo.

Scale: one map pass without a shuffle; a worker holds one Arrow batch and the memo.

Defined cases: a NULL text is an empty one, with 0 bytes and 0 tokens. Texts are read whole, special
strings in them are ordinary text. Repeated rows are counted one by one, an empty table gives no rows,
further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortsieve.llm.pieces import SPACE, Pieces, broadcast_model, loaded, pretokens
from cohortsieve.llm.registry import query
from cohortsieve.llm.texts import table, text_of

LIMIT = 4096
#: A worker forgets merged pre-tokens beyond so many, and never keeps ones longer than this.
MEMO, MEMO_CHARS = 500_000, 64


def whole_tokens(pieces: Pieces) -> set[str]:
    """Pre-tokens, without their first space, that the library encodes as one token each."""
    likely = [pieces.piece[i][1:].replace(SPACE, " ") for i in pieces.normal if pieces.piece[i].startswith(SPACE)]
    return {p for p, ids in zip(likely, pieces.encode(likely)) if len(ids) == 1}


class Counter:
    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.whole = dict.fromkeys(whole_tokens(pieces), 1)
        self.known = dict(self.whole)

    def count(self, texts: list[str]) -> list[int]:
        out = []
        for text in texts:
            pre = pretokens(text)
            rest = [p for p in set(pre) if p not in self.known]
            merged = dict(zip(rest, map(len, self.pieces.encode(rest)))) if rest else {}
            if len(self.known) + len(merged) > MEMO:
                self.known = dict(self.whole)
            self.known.update((p, n) for p, n in merged.items() if len(p) <= MEMO_CHARS)
            known = self.known
            try:
                out.append(sum(map(known.__getitem__, pre)))
            except KeyError:
                out.append(sum(known[p] if p in known else merged[p] if p in merged else
                               len(self.pieces.encode([p])[0]) for p in pre))
        return out


_COUNTERS: dict[int, Counter] = {}


def _counter(pieces: Pieces) -> Counter:
    if id(pieces) not in _COUNTERS:
        _COUNTERS[id(pieces)] = Counter(pieces)
    return _COUNTERS[id(pieces)]


def count_tokens(docs: DataFrame, model: Broadcast, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit), one row per row of ``docs``."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(loaded(model.value))
        for b in batches:
            n = counter.count(b.column("text").to_pylist())
            yield pa.record_batch({"doc_id": b.column("doc_id"), "n_bytes": b.column("n_bytes"),
                                   "n_tokens": pa.array(n, pa.int64())})

    rows = docs.select("doc_id", text_of().alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    return rows.mapInArrow(per_batch, kind).withColumn("over_limit", F.col("n_tokens") > limit)


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), broadcast_model(spark))
