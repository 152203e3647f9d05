"""Byte-level BPE ids of whole texts, fast: chunks between single blanks are looked up in a bounded cache.

The byte-level pre-tokenizer gives a blank to the word after it, so a text may be cut before any
blank that stands next to something else than white space, and the ids of " chunk" do not depend on
what is around it. Texts with a blank between white space, control characters or a special
token go to the tokenizer whole. Ids are little-endian unsigned 32-bit bytes.
"""

from __future__ import annotations

import base64
import functools
import re
from collections import defaultdict
from collections.abc import Iterable
from itertools import chain, islice

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: Chunks kept by a worker, up to a batch's more; about 60 MB.
CACHE_ENTRIES = 400_000
_ODD = re.compile("\\s (?=\\s|\\Z)|[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f  ]|<\\|endoftext\\|>")


def is_odd(text: str) -> bool:
    """Whether the text can't be cut before its blanks."""
    return _ODD.search(text) is not None


class ByteBpe:
    """Encoder for a vocabulary given both as `tokenizers` JSON and as ranks.

    Chunks get numbers, and `flat` has their ids one after the other, so a batch of texts is encoded
    by looking up its chunks and one gather. New chunks of a batch are encoded together. The table is
    emptied when it is full, so memory stays bounded.
    """

    def __init__(self, json_path: str, ranks_path: str) -> None:
        self.whole = Tokenizer.from_file(json_path)
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.size = self.whole.get_vocab_size()
        self.bytes_of = np.zeros(self.size, dtype=np.int64)
        self.bytes_of[list(ranks.values())] = list(map(len, ranks))
        self.forget()

    def forget(self) -> None:
        numbers: dict[str, int] = defaultdict(lambda: len(numbers))
        self.numbers = numbers
        self.flat = np.zeros(0, dtype="<u4")
        self.start = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)

    def whole_ids(self, text: str) -> np.ndarray:
        """Ids of an odd text."""
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def head_ids(self, head: str) -> np.ndarray:
        """Ids of what stands before the first blank."""
        return np.array(self.encoding.encode_ordinary(head), dtype="<u4")

    def numbered(self, rests: Iterable[list[str]], count: int) -> np.ndarray:
        """Numbers of the chunks after first blanks, whose ids are in `flat` then."""
        if len(self.numbers) > CACHE_ENTRIES:
            self.forget()
        found = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(rests)), np.int64, count)
        new = list(islice(self.numbers, len(self.start), None))
        if new:
            self._look_at(new)
        return found

    def _look_at(self, new: list[str]) -> None:
        # Chunks with white space at an end can't stand next to any other.
        alone = [i for i, c in enumerate(new) if not c or c[0].isspace() or c[-1].isspace()]
        others = new
        if alone:
            apart = set(alone)
            others = [c for i, c in enumerate(new) if i not in apart]
        length = np.zeros(len(new), dtype=np.int64)
        together = np.array(self.encoding.encode_ordinary("".join([f" {c}" for c in others])), dtype="<u4")
        ends = np.cumsum(np.fromiter((len(c.encode("utf-8", "surrogatepass")) + 1 for c in others), np.int64, len(others)))
        stops = np.searchsorted(np.cumsum(self.bytes_of[together]), ends) + 1
        place = np.ones(len(new), dtype=bool)
        place[alone] = False
        length[place] = np.diff(stops, prepend=0)
        start = np.zeros(len(new), dtype=np.int64)
        start[place] = stops - length[place]
        parts, at = [self.flat, together], len(together)
        for i in alone:
            ids = self.head_ids(" " + new[i])
            start[i], length[i], at = at, len(ids), at + len(ids)
            parts.append(ids)
        self.start = np.concatenate([self.start, start + len(self.flat)])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate(parts)

    def batch_ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        found: list[np.ndarray | None] = [self.whole_ids(t) if is_odd(t) else None for t in texts]
        rest = [t.split(" ") for t, ids in zip(texts, found, strict=True) if ids is None]
        heads = [self.head_ids(chunks[0]) for chunks in rest]
        sizes = np.array([len(chunks) - 1 for chunks in rest], dtype=np.int64)
        numbers = self.numbered((islice(chunks, 1, None) for chunks in rest), int(sizes.sum()))
        length = self.length[numbers]
        stop = np.cumsum(length)
        gathered = self.flat[np.repeat(self.start[numbers] - stop + length, length) + np.arange(stop[-1] if len(stop) else 0)]
        ends = np.concatenate([[0], stop])[np.cumsum(sizes)]
        start, tails = 0, iter(zip(heads, ends.tolist(), strict=True))
        for i, ids in enumerate(found):
            if ids is None:
                head, end = next(tails)
                found[i], start = np.concatenate([head, gathered[start:end]]), end
        return found

    def ids(self, text: str) -> bytes:
        return self.batch_ids([text])[0].tobytes()


@functools.lru_cache(maxsize=2)
def byte_bpe(json_path: str, ranks_path: str) -> ByteBpe:
    return ByteBpe(json_path, ranks_path)


def default_paths() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
