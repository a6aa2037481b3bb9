"""Tokenizers from public vocabulary files, for exact token budgets."""

from __future__ import annotations

import base64


class RankTokenizer:
    """Factory of a byte-pair tokenizer: a file of ``base64 rank`` lines and the pattern
    that splits texts before pairs are merged.

    The file is read where the factory is made, on the driver; the tasks get its bytes
    with the factory and build the tokenizer once each.  Strings of special tokens in a
    text are ordinary text.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = f.read()
        self.pattern = pattern

    def __call__(self) -> "_Encoding":
        import tiktoken
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, self.ranks.splitlines())}
        return _Encoding(tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={}))


class _Encoding:
    def __init__(self, encoding):
        self.encode = encoding.encode_ordinary
        self.decode = encoding.decode  # a character cut in its bytes becomes U+FFFD
