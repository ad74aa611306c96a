"""Loading of public tokenizer files inside tasks (once per Python worker)."""

from __future__ import annotations

import base64
from functools import lru_cache

# Fixed value: the published split pattern of the 50k byte-level BPE vocabularies.
BYTE_BPE_PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """The `tokenizers` object of a .json file, without truncation or padding."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def load_ranks(path: str):
    """A tiktoken encoder of a .tiktoken rank file (same ids as the .json of that vocabulary)."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def special_strings(path: str) -> tuple[str, ...]:
    return tuple(t.content for t in load_tokenizer(path).get_added_tokens_decoder().values())
