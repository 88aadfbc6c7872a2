"""A SentencePiece BPE vocabulary as the operators of this subpackage need it, loaded once per worker."""

from __future__ import annotations

import re

from pyspark import Broadcast
from pyspark.sql import SparkSession

SPACE = "▁"
#: A pre-token is a run of spaces and what follows up to the next space; merges never cross its ends.
_PRETOKEN = re.compile(" +[^ ]*")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def broadcast_model(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The model file's bytes (about 0.5 MB, whatever the data), read on the driver."""
    with open(path or default_model(), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text, each without its first space.

    The model puts a space before every non-empty text, and reads U+2581 as a space.
    """
    if not text:
        return []
    text = text.replace(SPACE, " ")
    if "  " not in text and text[0] != " ":
        return text.split(" ")
    return [p[1:] for p in _PRETOKEN.findall(" " + text)]


class Pieces:
    """The library's processor, its pieces, and the proof that pre-tokens can be encoded on their own."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(self.sp.vocab_size())
        self.piece = [self.sp.id_to_piece(i) for i in ids]
        self.normal = [i for i in ids if not (self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_byte(i))]
        self.byte_id = {int(self.piece[i][3:5], 16): i for i in ids if self.sp.is_byte(i)}
        for i in self.normal:
            if SPACE in self.piece[i].lstrip(SPACE):
                raise ValueError(f"piece {self.piece[i]!r} holds a space after another character")
        if self.sp.normalize("  x  ﬁ  ") != SPACE * 3 + "x" + SPACE + " ﬁ" + SPACE * 2:
            raise ValueError("the model changes texts before it encodes them")
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte fallback")

    def encode(self, pre: list[str]) -> list[list[int]]:
        """The ids of pre-tokens given without their first space, by the library."""
        return self.sp.encode([p if p else " " for p in pre], num_threads=1) if "" not in pre else [
            self.sp.encode(p) if p else [self.sp.piece_to_id(SPACE)] for p in pre]


_LOADED: dict[int, Pieces] = {}


def loaded(model: bytes) -> Pieces:
    """The vocabulary, built once per Python process."""
    key = hash(model)
    if key not in _LOADED:
        _LOADED[key] = Pieces(model)
    return _LOADED[key]
