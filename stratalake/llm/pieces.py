"""The vocabulary of a SentencePiece model, read as a unigram model.

A unigram encoder takes the segmentation of the highest summed score. It goes
through the text from left to right; where several paths reach a place with the same
score, the first found stays, and paths are tried from the earliest start on, so the
longest last piece wins. A character that is no piece costs ``UNKNOWN`` less than the
worst piece and falls back to its bytes.

Spaces are written as ``SPACE`` and one is put in front of the text. No piece holds a
``SPACE`` behind another character (checked on loading), so the text is cut into units
(a run of spaces with the characters up to the next) which no piece crosses, and each
unit is encoded for itself. Scores are summed in double precision within a unit.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

SPACE = "▁"
UNKNOWN = 10.0
UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Piece types of the model format.
NORMAL, BYTE = 1, 6


@dataclass(frozen=True)
class Vocabulary:
    """Text, id and score of each normal piece, ids of the 256 byte pieces, all texts by
    id, and the score of a character that is no piece."""

    texts: tuple[str, ...]
    ids: tuple[int, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]
    by_id: tuple[bytes, ...]
    unknown: float


def load(path: str) -> Vocabulary:
    """Read on the driver; tasks get the vocabulary itself, not the path."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    norm = model.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
        raise ValueError("only models that keep the text as it is and put a space in front are supported")
    normal = [(i, p.piece, p.score) for i, p in enumerate(model.pieces) if p.type == NORMAL]
    bytes_ = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
    if len(bytes_) != 256:
        raise ValueError("the model has no byte pieces")
    if any(re.search(f"[^{SPACE}]{SPACE}", text) for _, text, _ in normal):
        raise ValueError("a piece holds a space behind another character")
    by_id = [b""] * len(model.pieces)
    for i, text, _ in normal:
        by_id[i] = text.replace(SPACE, " ").encode()
    for value, i in bytes_.items():
        by_id[i] = bytes([value])
    ids, texts, scores = zip(*normal)
    by_byte = tuple(bytes_[b] for b in range(256))
    return Vocabulary(texts, ids, scores, by_byte, tuple(by_id), min(scores) - UNKNOWN)


def units(text: str) -> list[str]:
    """The text as units; joined, they give the text with its space in front."""
    return UNIT.findall(SPACE + text.replace(" ", SPACE)) if text else []
