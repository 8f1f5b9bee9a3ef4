"""Public tokenizers inside tasks: ids of texts of any length and content."""

import base64
import functools
import re
from pathlib import Path


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def byte_bpe(path: str, added: dict[str, int] | None = None):
    """Ids of a text by a byte-level BPE vocabulary and the ``added`` tokens in it.

    The ranks give the same ids as the vocabulary's JSON form beside them, several times as
    fast; but their pattern gives up on a run of a million blanks. A part that holds one is encoded
    by the JSON form. Without ``added`` the string of an added token is ordinary text.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    bpe = tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_ranks(path), special_tokens={}
    )

    @functools.cache
    def slower() -> Tokenizer:
        own = Tokenizer.from_file(str(Path(path).with_suffix(".json")))
        own.encode_special_tokens = True
        return own

    def ordinary(text: str) -> list[int]:
        try:
            return bpe.encode(text, disallowed_special=())
        except ValueError:
            return slower().encode(text, add_special_tokens=False).ids

    if not added:
        return ordinary
    # the longest first, so that no added token hides a longer one
    strings = sorted(added, key=len, reverse=True)
    apart = re.compile("(" + "|".join(map(re.escape, strings)) + ")")

    def encode(text: str) -> list[int]:
        if not any(s in text for s in strings):
            return ordinary(text)
        ids: list[int] = []
        for i, part in enumerate(apart.split(text)):
            ids += [added[part]] if i % 2 else ordinary(part)
        return ids

    return encode
