"""Secret scans by token efficiency.

Random strings cost a byte-pair vocabulary many tokens: their characters-per-token ratio under a tiktoken
vocabulary is far below that of words, however rare. Candidates are long runs of key characters; known digests (hex of a
digest's length), UUIDs, dates and numbers are excluded first, then runs below ``max_ratio`` characters per
token are reported as kind ``entropy``, unless they are names whose every part (by marks or camel case) is a
word by the same ratio. A run that reads well as a whole (a path, a name or an assignment with a key behind it) is
taken apart at its marks, and its random stretches of parts are reported. Random strings of fewer than 20 characters are
not found. Fixed-form secrets (assignments, access keys, hex runs) are always reported.

One pass per partition, one row out per row in; the vocabulary is loaded once per Python worker.
Null text counts as empty; empty texts have no spans; repeated rows come out repeatedly; an empty table gives an empty
result; spans of equal start come in the listed order of their kinds; very long texts are scanned whole. Only the key and
the text are read (``redact`` keeps all columns as they are), so no other column can clash.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns, worker_cache

# The base kinds in their listed order and their patterns.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_MIN, ACCESS_MIN = 12, 18
ENTROPY = "entropy"

#: Runs of this many key characters are candidates.
MIN_RUN = 20
#: Characters per token below which a candidate counts as random.
MAX_RATIO = 2.2
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
NOT_RANDOM = re.compile(
    r"(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"      # UUID
    r"|[0-9+/_=-]+)\Z")                                             # numbers, dates, rules
PIECE = re.compile(r"[A-Za-z0-9]+")
UUID_OR_REST = re.compile(r"(?P<uuid>(?<![0-9a-fA-F])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-fA-F]))"
                          r"|(?:(?!(?<![0-9a-fA-F])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-fA-F])).)+")
NAME = re.compile(r"[A-Za-z]*(?:[-_/+=]+[A-Za-z]*)*[0-9]{0,4}\Z")   # letters joined by marks, a number behind
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")                  # of a name, by marks and camel case
#: Words too short to reach any ratio.
SHORT_WORDS = frozenset("a i an as at be by do go id if in io ip is it me my no of on or os so to ui up us we".split())


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed forms, leftmost non-overlapping per kind, by start then kind."""
    found = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return [(s, e, BASE_KINDS[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2]))]


def is_identifier(run: str) -> bool:
    """Known digests and identifiers, which are no secrets by themselves."""
    if NOT_RANDOM.match(run):
        return True
    return len(run) in DIGEST_LENGTHS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", run) is not None


def is_name(run: str, count_tokens: Callable[[str], int], max_ratio: float = MAX_RATIO) -> bool:
    """Identifiers whose every part is a word: cheap in tokens by itself."""
    return NAME.match(run) is not None and all(
        len(p) >= max_ratio * count_tokens(p) or p.lower() in SHORT_WORDS for p in PARTS.findall(run))


def best_stretch(gains: list[int]) -> tuple[int, int, int]:
    """(sum, first, end) of the stretch of largest sum: the one that ends first, then the shortest."""
    best, total, first = (0, 0, 0), 0, 0
    for i, g in enumerate(gains):
        if total <= 0:
            total, first = 0, i
        total += g
        if total > best[0]:
            best = (total, first, i + 1)
    return best


def hidden_spans(run: str, count_tokens: Callable[[str], int], max_ratio: float = MAX_RATIO) -> list[tuple[int, int]]:
    """Random stretches inside a run that reads well as a whole: a key behind a path, a name or an assignment.

    The run's parts between marks gain what they cost in tokens beyond the ratio and lose what they spare; the stretch of
    parts with the largest gain is a secret if it passes the tests of a whole run. So do the rest on both its sides.
    """
    thousandths = round(1000 * max_ratio)
    out = []
    for area in UUID_OR_REST.finditer(run):
        if area.lastgroup:  # a known identifier
            continue
        pieces = [(m.start(), m.end()) for m in PIECE.finditer(run, area.start(), area.end())]
        gains = []
        for s, e in pieces:
            gain = thousandths * count_tokens(run[s:e]) - 1000 * (e - s)
            gains.append(min(gain, 0) if run[s:e].isdigit() else -1000 * len(run) if is_identifier(run[s:e]) else gain)
        areas = [(0, len(pieces))]
        while areas:
            lo, hi = areas.pop()
            total, i, j = best_stretch(gains[lo:hi])
            if not total:
                continue
            i, j = i + lo, j + lo
            s, e = pieces[i][0], pieces[j - 1][1]
            found = run[s:e]
            if len(found) >= MIN_RUN and not is_identifier(found) and len(found) < max_ratio * count_tokens(found) \
                    and not is_name(found, count_tokens, max_ratio):
                out.append((s, e))
            areas += [(lo, i), (j, hi)]
    return sorted(out)


def entropy_spans(text: str, count_tokens: Callable[[str], int], max_ratio: float = MAX_RATIO) -> list[tuple[int, int, str]]:
    """Runs that are random as a whole, and the random stretches of the other ones."""
    out = []
    for m in CANDIDATE.finditer(text):
        run = m[0]
        if is_identifier(run):
            continue
        if len(run) >= max_ratio * count_tokens(run):
            out += [(m.start() + s, m.start() + e, ENTROPY) for s, e in hidden_spans(run, count_tokens, max_ratio)]
        elif not is_name(run, count_tokens, max_ratio):
            out.append((m.start(), m.end(), ENTROPY))
    return out


def token_counter(path: str) -> Callable[[str], int]:
    """Tokens of a string under the tiktoken ranks file at ``path``."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda s: len(enc.encode_ordinary(s))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _counter(path: str | None) -> Callable[[str], int]:
    path = path or vocabulary_path()
    return worker_cache(f"tiktoken:{path}", lambda: token_counter(path))


def spans_of(text: str, count_tokens: Callable[[str], int], max_ratio: float = MAX_RATIO):
    """All spans: base ones, and entropy runs that no base span covers; by start, then kind as listed."""
    base = base_spans(text)
    starts = [b[0] for b in base]
    reach = list(accumulate((b[1] for b in base), max))  # the farthest end so far
    extra = [s for s in entropy_spans(text, count_tokens, max_ratio)
             if not (i := bisect_right(starts, s[0])) or reach[i - 1] < s[1]]
    order = {k: i for i, k in enumerate((*BASE_KINDS, ENTROPY))}
    return base, sorted(base + extra, key=lambda x: (x[0], order[x[2]]))


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None,
         max_ratio: float = MAX_RATIO) -> DataFrame:
    """Per row: key, n_assign, n_access, n_hex, n_entropy, base_sha256, spans ("kind:start:end", code points)."""
    def rows(batches):
        count = _counter(vocabulary)
        for b in batches:
            out: dict = {c: [] for c in (key, "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans")}
            for k, t in zip(b[key], b[text]):
                base, every = spans_of(t or "", count, max_ratio)
                kinds = [s[2] for s in every]
                out[key].append(k)
                for name in (*BASE_KINDS, ENTROPY):
                    out[f"n_{name}"].append(kinds.count(name))
                out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out["spans"].append(_joined(every))
            yield out

    kind = docs.schema[key].dataType.simpleString()
    return map_columns(docs, [key, text], f"`{key}` {kind}, n_assign bigint, n_access bigint, n_hex bigint, "
                       "n_entropy bigint, base_sha256 string, spans string", rows)


def redacted(text: str, spans, mark: str = "[SECRET]") -> str:
    """The text with every span (overlaps merged) replaced by ``mark``; an assignment keeps its name."""
    out, at = [], 0
    for s, e, kind in sorted(spans):
        if kind == "assign" and s >= at:
            m = ASSIGN.match(text, s)
            s = m.start(2) if m else s
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], mark]
        at = e
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars", vocabulary: str | None = None,
           max_ratio: float = MAX_RATIO) -> DataFrame:
    """``docs`` with secrets replaced in ``text``; ``length``, if there, counts the changed texts anew.

    Keeps every row, column, type and null; texts without secrets stay as they are.
    """
    import pyarrow as pa

    schema = docs.schema
    names = docs.columns
    at = names.index(text)
    n_at = names.index(length) if length in names else None

    def run(batches):
        count = _counter(vocabulary)
        for b in batches:
            texts = b.column(at).to_pylist()
            arrays = list(b.columns)
            new = [t and redacted(t, spans_of(t, count, max_ratio)[1]) for t in texts]
            arrays[at] = pa.array(new, type=b.schema.field(at).type)
            if n_at is not None:
                was = arrays[n_at].to_pylist()
                arrays[n_at] = pa.array([n if t == u or t is None else len(u) for n, t, u in zip(was, texts, new)],
                                        type=b.schema.field(n_at).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=b.schema)

    return docs.mapInArrow(run, schema)
