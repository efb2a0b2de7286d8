"""Public tokenizer files; paths are parameters, nothing is copied."""

from __future__ import annotations

import base64
import functools
import os

FOLDER = "/opt/tokenizers"
PIECES = f"{FOLDER}/piece_bpe_32k.model"
RANKS = f"{FOLDER}/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pre-tokenizer pattern the byte-level vocabularies were made for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.lru_cache(2)
def byte_pairs(path: str = RANKS):
    """A tiktoken encoding over a rank file, once per worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(2)
def piece_vocabulary(path: str = PIECES) -> list[tuple[str, int]]:
    """(piece, rank) of all ordinary pieces of a sentencepiece model, most useful first."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return [(model.id_to_piece(i), k) for k, i in enumerate(ordinary)]
