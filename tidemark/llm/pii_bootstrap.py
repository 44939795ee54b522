"""Personal data by bootstrapped contextual extraction.

Fixed-form identifiers (email, ip, card, phone) are the seed entities. The words around an occurrence are
its lexical patterns: the two words before it, and the words on both sides. Patterns and instances form a
graph that Spark scores in rounds: a pattern's confidence in a kind is the share of its distinct instances
known as that kind; patterns with enough support and confidence vote for the other instances in their
places, and instances that enough votes agree on become known for the next round, until a round adds none.
Only token sequences that look like identifiers can be instances, so clean prose has nothing to find: chunks
between blanks that hold a digit of any script, '@', '_', '[at]' or a mark between word characters, joined over
single gaps ('726 555 1586', 'DE89 3704 0044', 'bob [at] mail [dot] com') to any length. Parts of a sequence
that are identifiers by themselves stand as further candidates, which count only where the whole was not found.

Base spans always stay. An instance found by context is reported wherever it stands, as ``found_<kind>``.
The texts are read once; what the scan keeps (counts, spans, identifier occurrences) is staged and all
later steps are grouped sums and joins over it. Null text counts as empty; an empty table gives an empty
result; repeated rows come out repeatedly (rows carry a staged row id) and count as further occurrences,
not as further instances. Very long texts take time in proportion to their length; only the key and the text
are read, so no other column can clash.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns, stage, with_row_id

# The base kinds in their listed order and their patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a match can only begin where a run of digits begins
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

MIN_SUPPORT = 3       # distinct known instances of a pattern
MIN_PATTERN = 0.8     # confidence of a pattern that may vote
MIN_INSTANCE = 0.9    # 1 - product of (1 - confidence) over the patterns of an instance
ROUNDS = 200          # rounds end by themselves when nothing is added; reaching this is an error
WINDOW = 80           # characters looked at first for context words
_MARK = r"[\[({<](?i:at|dot)[\])}>]"
_ANCHOR = re.compile(rf"[\d@_]|\b[:/=+.]+\b|{_MARK}")
_CHUNK = re.compile(r"\S+")
_MARK_AT = re.compile(_MARK)
_ENDS_IN_MARK = re.compile(rf"{_MARK}\Z")
_NEXT = re.compile(r"[\x20\t\xa0]{1,2}(?=\S)")
_JOIN = re.compile(r"[\x20\t\xa0]{1,2}(?:(?:[A-Z]{1,4}|[-/.\u2013]+)[\x20\t\xa0]{1,2})?")
_PART = re.compile(r"[A-Za-z0-9@._+-]{5,}")
_WORDS = re.compile(r"[^\W_]+")
_BRACKETS = {"(": ")", "[": "]", "{": "}", "<": ">"}
_OPENING = {b: a for a, b in _BRACKETS.items()}
_BREAKS = frozenset(",;.!?:")
_EDGE = "\"'`,;:!?*|.-"


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str):
    """Leftmost non-overlapping matches, found from the at-signs (linear however long a run is)."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of every base span, by kind as listed, then start."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) < 4 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _digits(m[0])
            if 13 <= len(d) <= 19 and _luhn(d):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


class Words:
    """Context words of a text: from the characters close by, or, where these are too few, from an index of all words
    that is made once."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, None, None

    def _index(self) -> None:
        if self.starts is None:
            spans = [m.span() for m in _WORDS.finditer(self.text)]
            self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]

    def before(self, at: int, n: int) -> list[str]:
        """The ``n`` nearest words before ``at``, lower-cased; a word over ``at`` is cut there."""
        found = _WORDS.findall(self.text, max(0, at - WINDOW), at)
        if len(found) > n or at <= WINDOW:  # the outermost of a window may be a fragment
            return [w.lower() for w in found[-n:]]
        self._index()
        i = bisect_left(self.starts, at)
        return [self.text[self.starts[j]:min(self.ends[j], at)].lower() for j in range(max(0, i - n), i)]

    def after(self, at: int) -> list[str]:
        """The nearest word behind ``at``, lower-cased; a word over ``at`` is cut there."""
        found = _WORDS.search(self.text, at, at + WINDOW)
        if found and found.end() < at + WINDOW:
            return [found[0].lower()]
        self._index()
        i = bisect_right(self.ends, at)
        return [self.text[max(self.starts[i], at):self.ends[i]].lower()] if i < len(self.ends) else []


def patterns(words: Words, start: int, end: int) -> list[str]:
    """The two words before, and the words on both sides, lower-cased."""
    before, after = words.before(start, 2), words.after(end)
    out = []
    if len(before) > 1:
        out.append(f"{before[-2]} {before[-1]} _")
    if before and after:
        out.append(f"{before[-1]} _ {after[0]}")
    return out


def _trimmed(text: str, s: int, e: int) -> tuple[int, int]:
    """Without outer punctuation and brackets that do not belong to the sequence."""
    absent: set[str] = set()  # what is not in a sequence is not in its parts

    def lacks(c: str) -> bool:
        if c not in absent and text.find(c, s, e) < 0:
            absent.add(c)
        return c in absent

    while s < e:
        first, last = text[s], text[e - 1]
        if first in _EDGE or first in _BRACKETS and lacks(_BRACKETS[first]):
            s += 1
        elif last in _EDGE or last in "_+" or last in _OPENING and lacks(_OPENING[last]):
            e -= 1
        elif _BRACKETS.get(first) == last and text.find(last, s, e) == e - 1:
            s, e = s + 1, e - 1
        else:
            break
    return s, e


def sequences(text: str, taken: list[tuple[int, int]]):
    """(start, end) of the identifier-like token sequences outside ``taken`` (sorted, disjoint spans)."""
    starts = [a for a, _ in taken]

    def free(s: int, e: int) -> bool:
        i = bisect_left(starts, e) - 1
        return i < 0 or taken[i][1] <= s

    def chunk_before(e: int, least: int) -> int:
        s = e
        while s > least and not text[s - 1].isspace():
            s -= 1
        return s

    begin = end = -1
    at = 0
    while m := _ANCHOR.search(text, at):
        s, e = chunk_before(m.start(), at), _CHUNK.match(text, m.start()).end()
        at = e
        if not free(s, e):
            continue
        joined = begin >= 0 and s > end and text[end - 1] not in _BREAKS and _JOIN.fullmatch(text, end, s) and free(end, s)
        if not joined:
            if begin >= 0:
                yield begin, end
            begin = s
            if _MARK_AT.match(text, s):  # the word before belongs to it
                gap = s
                while gap > max(end, 0) and s - gap < 2 and text[gap - 1] in " \t\xa0":
                    gap -= 1
                before = chunk_before(gap, max(end, 0)) if gap < s else s
                if before < gap and free(before, gap):
                    begin = before
        end = e
        if _ENDS_IN_MARK.search(text, max(s, e - 5), e) and (gap := _NEXT.match(text, e)):
            e = _CHUNK.match(text, gap.end()).end()
            if free(gap.end(), e):
                end = at = e
    if begin >= 0:
        yield begin, end


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds and identifier-like sequences with their patterns; what is inside base spans are the seeds themselves.

    ``seq`` is where the sequence begins; ``whole`` is false for its parts.
    """
    words = Words(text)
    out = [{"s": s, "e": e, "kind": KINDS[k], "inst": text[s:e].lower(), "pats": patterns(words, s, e), "seq": s, "whole": True}
           for k, s, e in base]
    taken: list[tuple[int, int]] = []
    for s, e in sorted((s, e) for _, s, e in base):
        if taken and s < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
        else:
            taken.append((s, e))

    def add(s: int, e: int, seq: int, whole: bool) -> None:
        out.append({"s": s, "e": e, "kind": None, "inst": text[s:e].lower(), "pats": patterns(words, s, e), "seq": seq,
                    "whole": whole})

    for a, b in sequences(text, taken):
        s, e = _trimmed(text, a, b)
        if e - s > 1 and _WORDS.search(text, s, e):  # marks alone identify nothing
            add(s, e, a, True)
        for m in _PART.finditer(text, a, b):
            part = m[0].rstrip("._+-")
            if len(part) >= 5 and (m.start(), m.start() + len(part)) != (s, e) and \
                    ("@" in part or any("0" <= c <= "9" for c in part)):
                add(m.start(), m.start() + len(part), a, False)
    return out


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, base counts, base_sha256, base (spans) and occ (identifier occurrences with patterns)."""
    def rows(batches):
        for b in batches:
            out: dict = {c: [] for c in (key, *(f"n_{k}" for k in KINDS), "base_sha256", "base", "occ")}
            for k, t in zip(b[key], b[text]):
                base = base_spans(t or "")
                out[key].append(k)
                for i, name in enumerate(KINDS):
                    out[f"n_{name}"].append(sum(x[0] == i for x in base))
                joined = _joined(base)
                out["base_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                out["base"].append(joined)
                out["occ"].append(occurrences(t or "", base))
            yield out

    kind = docs.schema[key].dataType.simpleString()
    return map_columns(docs, [key, text], f"`{key}` {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                       "base_sha256 string, base string, "
                       "occ array<struct<s: int, e: int, kind: string, inst: string, pats: array<string>, seq: int, "
                       "whole: boolean>>", rows)


def bootstrap(occ: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT,
              min_pattern: float = MIN_PATTERN, min_instance: float = MIN_INSTANCE) -> tuple[DataFrame, DataFrame]:
    """(known instances (inst, kind, score), accepted patterns (pat, kind, conf)) from occurrences.

    An instance seen as several kinds counts for the most frequent one (ties: by hash of the name). Patterns are
    judged by whole sequences only and vote for parts too. Rounds go on until one adds nothing.
    """
    edges = stage(occ.select("inst", F.explode("pats").alias("pat"), "whole").groupBy("inst", "pat").agg(F.max("whole").alias("whole")),
                  "pii-edges")
    judged = edges.where("whole")
    known = stage(occ.where("kind is not null").groupBy("inst", "kind").agg(F.count("*").alias("n"))
                  .groupBy("inst").agg(F.max_by("kind", F.struct("n", F.hash("kind"))).alias("kind"))
                  .select("inst", "kind", F.lit(1.0).alias("score")), "pii-known")
    accepted = None
    for _ in range(rounds):
        size = judged.groupBy("pat").agg(F.count("*").alias("size"))
        votes = judged.join(known, "inst").groupBy("pat", "kind").agg(F.sum("score").alias("mass"), F.count("*").alias("n"))
        accepted = stage(votes.join(size, "pat").select("pat", "kind", "n", (F.col("mass") / F.col("size")).alias("conf"))
                         .where((F.col("n") >= min_support) & (F.col("conf") >= min_pattern)).drop("n"), "pii-patterns")
        # ln(1 - conf) sums over patterns; a pattern never counts as fully certain
        miss = F.log(F.greatest(1 - F.col("conf"), F.lit(0.05)))
        new = (edges.join(accepted, "pat").join(known.select("inst"), "inst", "left_anti")
               .groupBy("inst", "kind").agg((1 - F.exp(F.sum(miss))).alias("score"))
               .groupBy("inst").agg(F.max(F.struct("score", "kind")).alias("b"))
               .select("inst", "b.kind", "b.score").where(F.col("score") >= min_instance))
        new = stage(new, "pii-new")
        if not new.take(1):
            break
        known = stage(known.unionByName(new), "pii-known")
    else:
        raise RuntimeError(f"bootstrapping still added instances after {rounds} rounds")
    return known, accepted


def extract(docs: DataFrame, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """Per row: key, n_email, n_ip, n_card, n_phone, n_found, base_sha256, spans ("kind:start:end", code points)."""
    rid = "__rid"
    rows = with_row_id(scan(docs, key, text), rid, "pii-scan")
    occ = rows.where(F.size("occ") > 0).select(rid, F.explode("occ").alias("o")).select(rid, "o.*")
    known, _ = bootstrap(occ, **limits)
    found = (occ.where("kind is null").select(rid, "s", "e", "inst", "seq", "whole").join(known.select("inst", "kind"), "inst")
             .withColumn("covered", F.max("whole").over(Window.partitionBy(rid, "seq"))).where("whole or not covered")
             .groupBy(rid).agg(F.sort_array(F.collect_list(F.struct(
                 F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("k"), "s", "e", "kind"))).alias("f")))
    text_of = F.transform("f", lambda x: F.concat(F.lit("found_"), x["kind"], F.lit(":"), x["s"].cast("string"),
                                                  F.lit(":"), x["e"].cast("string")))
    return (rows.join(found, rid, "left")
            .select(key, "n_email", "n_ip", "n_card", "n_phone",
                    F.coalesce(F.array_size("f"), F.lit(0)).cast("long").alias("n_found"), "base_sha256",
                    F.array_join(F.filter(F.concat(F.array("base"), F.coalesce(text_of, F.array().cast("array<string>"))),
                                          lambda x: x != ""), ",").alias("spans")))
