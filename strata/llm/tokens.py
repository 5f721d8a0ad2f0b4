"""The byte-level BPE vocabulary that packing and token counting share; vocabulary files are read, never copied."""

from __future__ import annotations

import base64
import functools
import os
import re

import numpy as np
import public_tokenizers

END_TEXT = "<|endoftext|>"
#: The rank encoder gives up on runs of white space of about a million characters.
LONG_SPACE = re.compile(r"\s{100000}")


@functools.cache
def encoder(ranks_path: str | None = None):
    """Ids equal to those of ``byte_bpe_50k.json``; the same vocabulary as ranks is encoded several times faster."""
    import tiktoken

    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={END_TEXT: len(ranks)})


@functools.cache
def patient_encoder(special: bool, json_path: str | None = None):
    """The JSON tokenizer, slower but fit for any text; ``special`` tells whether the end text in a text is one id."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(json_path or public_tokenizers.path("byte_bpe_50k.json"))
    out.encode_special_tokens = not special
    return out


def encode(text: str | None, ranks_path: str | None = None, *, special: bool = True, json_path: str | None = None) -> np.ndarray:
    """Ids of a text; with ``special`` the end text within it becomes its own id, otherwise it is ordinary text."""
    if not text:
        return np.zeros(0, np.uint32)
    if len(text) >= 100_000 and LONG_SPACE.search(text):
        ids = patient_encoder(special, json_path).encode(text, add_special_tokens=False).ids
    elif special and END_TEXT in text:
        ids = encoder(ranks_path).encode(text, allowed_special={END_TEXT})
    else:
        ids = encoder(ranks_path).encode_ordinary(text)
    return np.array(ids, np.uint32)
