"""Token ids of whole texts under the public vocabularies.

``ByteTokenizer`` gives the ids of the byte-level vocabulary straight from its ranks (the tiktoken file of
the same vocabulary gives the ids of the tokenizers file). A vocabulary's special strings in a text get their
own ids, as the tokenizers library does by default; what stands between them is tokenized by itself. ``WordTokenizer`` uses the tokenizers library
behind a memo: that vocabulary lower-cases, drops white space and never joins over it, so a text's ids are
those of its white-space separated chunks in a row, and every distinct chunk is encoded once per memo. A
cut between plain letters and marks changes no id and makes chunks repeat more often. Arrow tells the distinct
chunks of many texts apart, and only those are looked up. The memo is bounded and only saves time.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa

from tidemark.llm.common import worker_cache

# The special tokens of the vocabularies.
BYTE_SPECIALS = {"<|endoftext|>": 50256}
WORD_SPECIALS = {"<|startoftext|>": 49406, "<|endoftext|>": 49407}

MEMO = 800_000
PART, PARTS = 4096, 256  # chunks of a part, and parts looked up at once: every distinct chunk of them once
TOGETHER = 128  # new chunks tokenized in one call
_PLAIN = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x20 if 0x09 <= c <= 0x0D else c for c in range(256))
_LETTER = np.array([0x61 <= c <= 0x7A for c in range(256)])
_LATIN = np.array([0x80 <= c <= 0xBF and c not in (0x97, 0xB7) for c in range(256)])  # behind \xC3: letters up to U+00FF
_MARK, _NEXT = 1, 2  # marks but the apostrophe (it may begin a contraction); plain letters, digits and spaces
_KIND = np.array([_NEXT if chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz " else _MARK if 0x21 <= c <= 0x7E and c != 0x27
                  else 0 for c in range(256)], dtype=np.uint8)


def cuts_of(raw: np.ndarray) -> np.ndarray:
    """Where chunks begin: at every space, and at and behind runs of marks that stand between letters, digits or spaces."""
    kind = _KIND[raw]
    cut = raw == 0x20
    mark = np.flatnonzero(kind == _MARK)
    if len(mark):
        edge = np.flatnonzero(np.diff(mark) > 1)
        first, last = mark[np.concatenate([[0], edge + 1])], mark[np.concatenate([edge, [len(mark) - 1]])]
        free = (first == 0) | (kind[first - 1] == _NEXT)
        free &= (last == len(raw) - 1) | (kind[np.minimum(last + 1, len(raw) - 1)] == _NEXT)
        cut[first[free]] = True
        behind = last[free] + 1
        cut[behind[behind < len(raw)]] = True
    return np.flatnonzero(cut)


def of_letters(lines: np.ndarray) -> np.ndarray:
    """Whether each line (all end in \\n) is not empty and of letters up to U+00FF alone."""
    lead = np.append(False, lines == 0xC3)
    latin = _LATIN[lines] & lead[:-1]
    fine = _LETTER[lines] | latin
    fine[:-1] |= latin[1:]
    end = np.flatnonzero(lines == 0x0A)
    begin = np.append(0, end[:-1] + 1)
    seen = np.append(0, np.cumsum(fine))
    return (end > begin) & (seen[end] - seen[begin] == end - begin)


class ByteTokenizer:
    """``ids(text)`` -> unsigned 32-bit ids."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens=BYTE_SPECIALS)

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype="<u4")
        if any(s in text for s in BYTE_SPECIALS):
            return np.array(self.encoding.encode(text, allowed_special="all"), dtype="<u4")
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4")


class Memo(dict):
    """Numbers of chunks in the order they are first met; the new ones are noted."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        n = self[chunk] = len(self)
        self.new.append(chunk)
        return n


class WordTokenizer:
    """``ids(text)`` -> little-endian unsigned 32-bit ids as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # split off beforehand: lower-casing must not make one
        # letters alone are one word: nothing to compose or to split but the spaces between such chunks
        self.words = Tokenizer.from_file(path)
        self.words.normalizer = normalizers.Lowercase()
        self.words.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.special = re.compile("(" + "|".join(map(re.escape, WORD_SPECIALS)) + ")")
        self._forget()

    def _forget(self) -> None:
        """An empty memo: chunk ``i`` has the ``size[i]`` ids of the pool from ``first[i]`` on."""
        self.memo, self.pool = Memo(), np.zeros(0, dtype="<u4")
        self.first, self.size = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)

    def _learn(self) -> None:
        """Adds the ids of new chunks, many as one text (a call a chunk costs several times as much)."""
        # a chunk has no line ends, and at most one space, in front
        lines = b"\n".join([b"", *self.memo.new, b""]).replace(b"\n ", b"\n")[1:]
        new, self.memo.new = lines.decode("utf-8", "surrogatepass").split("\n")[:-1], []
        alone = of_letters(np.frombuffer(lines, dtype=np.uint8))
        size, pools = np.zeros(len(new), dtype=np.int32), [self.pool]
        order = np.concatenate([np.flatnonzero(alone), np.flatnonzero(~alone)])
        for which, at in ((True, order[:alone.sum()]), (False, order[alone.sum():])):
            chunks = [new[i] for i in at.tolist()]
            for lo in range(0, len(at), TOGETHER):
                part = chunks[lo:lo + TOGETHER]
                text = " ".join(part)
                if which:
                    told = self.words.encode(text, add_special_tokens=False)
                    of = np.array(told.word_ids, dtype=np.int64)
                else:  # offsets tell whose an id is
                    told = self.tokenizer.encode(text, add_special_tokens=False)
                    begin = np.cumsum([0, *(len(x) + 1 for x in part)])
                    of = np.searchsorted(begin, np.array([a for a, _ in told.offsets], dtype=np.int64), "right") - 1
                pools.append(np.array(told.ids, dtype="<u4"))
                size[at[lo:lo + TOGETHER]] = np.bincount(of, minlength=len(part))
        first = np.empty(len(new), dtype=np.int32)
        first[order] = len(self.pool) + np.cumsum(size[order]) - size[order]
        self.pool = np.concatenate(pools)
        self.first, self.size = np.concatenate([self.first, first]), np.concatenate([self.size, size])

    def _ids_of(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of some chunks in a row, where each chunk's begin, and their end)."""
        if len(self.memo) > MEMO:
            self._forget()
        told = chunks.dictionary_encode()
        distinct = told.dictionary.to_numpy(zero_copy_only=False).tolist()
        of = np.fromiter(map(self.memo.__getitem__, distinct), dtype=np.int32, count=len(distinct))
        if self.memo.new:
            self._learn()
        of = of[told.indices.to_numpy()]
        size = self.size[of]
        at = np.zeros(len(of) + 1, dtype=np.int64)
        np.cumsum(size, out=at[1:])
        return self.pool[np.repeat(self.first[of] - at[:-1], size) + np.arange(at[-1])], at

    def ids(self, text: str | None) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of some texts; what none of them has met before is tokenized together."""
        if any(t and "<|" in t and self.special.search(t) for t in texts):
            if len(texts) > 1:
                return [self.ids(t) for t in texts]
            return [b"".join(np.array([WORD_SPECIALS[x]], dtype="<u4").tobytes() if x in WORD_SPECIALS else self.ids(x)
                             for x in self.special.split(texts[0]))]
        # every text begins with a space, which begins a chunk
        body = [b" " + t.encode("utf-8", "surrogatepass") if t else b" " for t in texts]
        raw = b"".join(body).translate(_PLAIN)
        cut = cuts_of(np.frombuffer(raw, dtype=np.uint8))
        begin = np.searchsorted(cut, np.cumsum([0, *map(len, body)]))  # the first chunk of every text, and their number
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut), [
            None, pa.py_buffer(np.append(cut, len(raw))), pa.py_buffer(raw)])
        ids, ends = [], np.zeros(len(begin), dtype=np.int64)
        total = 0
        for lo in range(0, len(cut), PART * PARTS):  # some chunks at a time, so that the memo may be cleared in between
            some, at = self._ids_of(chunks.slice(lo, PART * PARTS))
            here = np.flatnonzero((begin > lo) & (begin <= lo + len(at) - 1))
            ends[here] = total + at[begin[here] - lo]
            ids.append(some)
            total += len(some)
        flat = np.concatenate(ids) if ids else self.pool[:0]
        return [flat[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def byte_tokenizer(path: str | None) -> ByteTokenizer:
    path = path or public_path("byte_bpe_50k.tiktoken")
    return worker_cache(f"byte:{path}", lambda: ByteTokenizer(path))


def word_tokenizer(path: str | None) -> WordTokenizer:
    path = path or public_path("word_bpe_49k.json")
    return worker_cache(f"word:{path}", lambda: WordTokenizer(path))


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
