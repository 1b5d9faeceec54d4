"""Personal data in texts, also where it is written in disguise.

Plain identifiers are found on the text itself. Then rewriting steps undo the
disguises: look-alike and full-width characters become ASCII and invisible
ones go, spelled digits become digits, bracketed or spelled "at" and "dot"
become signs. Each step keeps, for every piece of its output, where it came
from, so an identifier found in the rewritten text is reported by its place in
the original. Only finds that touch a rewritten piece and that no plain find
of their kind covers are added, beside the plain finds that they overlap.

Defined results: null and empty texts have no spans; ids may be null or
repeat; rows are independent of each other, other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<kind:string,start:long,end:long,plain:boolean>>"

# --- plain identifiers -------------------------------------------------------

_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A failing start inside a run of digits fails at the run's first digit too.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str):
    """Matches of local@domain: from each @, left over the local part's
    characters and right over the domain, so no start is tried twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_SET:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), leftmost and non-overlapping within a kind."""
    out = [(s, e, "email") for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = "".join(_DIGIT.findall(m.group()))
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append((*m.span(), "phone"))
    return out


# --- rewriting with offsets --------------------------------------------------

class Rewritten:
    """A text made of pieces, each copied from the source or put in its place."""

    def __init__(self, text: str, pieces: list[tuple[int, int, int, bool]]):
        self.text, self.pieces = text, pieces  # (start here, source start, source end, copied)
        self.starts = [p[0] for p in pieces]

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """The source span behind text[start:end], and whether it holds a piece that was put in."""
        i, j = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        at, s, _, copied = self.pieces[i]
        low = s + start - at if copied else s
        at, s, e, copied_last = self.pieces[j]
        high = s + end - at if copied_last else e
        return low, high, high - low != end - start or not all(p[3] for p in self.pieces[i:j + 1])


def rewrite(text: str, pattern: re.Pattern, put) -> Rewritten | None:
    """Replace each match by ``put(match)`` (None leaves it), keeping offsets."""
    out, pieces, done, here = [], [], 0, 0
    for m in pattern.finditer(text):
        new = put(m)
        if new is None:
            continue
        if m.start() > done:
            pieces.append((here, done, m.start(), True))
            out.append(text[done:m.start()])
            here += m.start() - done
        if new:
            pieces.append((here, m.start(), m.end(), False))
            out.append(new)
            here += len(new)
        done = m.end()
    if not done:
        return None
    if done < len(text):
        pieces.append((here, done, len(text), True))
        out.append(text[done:])
    return Rewritten("".join(out), pieces)


def _look_alikes() -> dict[str, str]:
    """Characters whose compatibility form is one ASCII sign, by rule, and
    letters of other scripts drawn like Latin ones."""
    out = {}
    for block in (range(0xFF01, 0xFF5F), range(0x1D400, 0x1D800), range(0x2460, 0x24FF), range(0x2070, 0x2090),
                  range(0x0660, 0x066A), range(0x06F0, 0x06FA), range(0x0966, 0x0970), range(0xFE50, 0xFE70), (0x2024, 0xFF61)):
        for c in map(chr, block):
            plain = unicodedata.normalize("NFKC", c)
            digit = unicodedata.digit(c, None)
            if digit is not None:
                plain = str(digit)
            if len(plain) == 1 and plain.isascii():
                out[c] = plain
    # Cyrillic and Greek letters and signs that look like ASCII ones.
    pairs = "аa еe оo рp сc хx уy іi јj ѕs һh ԁd ԛq ԝw кk мm тt вb АA ВB ЕE КK МM НH ОO РP СC ТT ХX УY ІI ЅS αa οo ρp νv ιi κk υu ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ‐- ‑- –- −- 。. ․."
    out.update((p[0], p[1]) for p in pairs.split())
    return out


_ALIKE = _look_alikes()
_INVISIBLE = "­​‌‍⁠﻿"
_ODD = re.compile(f"[{''.join(map(re.escape, _ALIKE))}{_INVISIBLE}]")
_HAS_ODD = re.compile("[\xad\u0370-\U0010ffff]")

# Spelled digits.
_SPELLED = dict(zip("zero oh one two three four five six seven eight nine".split(), "00123456789"))
_NUMBER_WORD = rf"(?:{'|'.join(_SPELLED)})"
_SAID = rf"(?:(?:double|triple)[\s-]+)?(?:{_NUMBER_WORD}|[0-9]+)"
_JOIN = r"(?:[\s,]+(?:-[\s,]*)?|-[\s,]*)"  # signs with at most one hyphen, matched in one way only
_SPELLED_RUN = re.compile(
    rf"(?<!\w)(?:plus{_JOIN}|\+\s*)?{_SAID}(?:{_JOIN}(?:{_SAID}|(?:dot|point)(?={_JOIN}{_SAID}))){{3,}}(?!\w)", re.I)
_SPELLED_TOKEN = re.compile(r"plus|\+|double|triple|dot|point|[0-9]+|[a-z]+", re.I)
# A run has four items or more, so each word of it has another item right after or right before it.
_ITEM_WORD = rf"(?:{_NUMBER_WORD}|double|triple|dot|point)"
_HAS_SPELLED = re.compile(rf"(?<!\w)(?:{_ITEM_WORD}|plus)[\s,-]+(?:{_ITEM_WORD}|[0-9])|[0-9][\s,-]+{_ITEM_WORD}(?!\w)", re.I)


def spelled_digits(m: re.Match) -> str | None:
    """The run in digits and signs; one without words spells nothing and stays."""
    out, times, words = [], 1, 0
    for t in _SPELLED_TOKEN.findall(m.group().lower()):
        words += t.isalpha()
        if t in ("double", "triple"):
            times = 2 if t == "double" else 3
            continue
        out.append({"plus": "+", "dot": ".", "point": "."}.get(t, _SPELLED.get(t, t)) * times)
        times = 1
    return "".join(out) if words else None


_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_BRACKETED = re.compile(rf"\s*{_OPEN}\s*(at|dot|@|\.)\s*{_CLOSE}\s*", re.I)
_HAS_BRACKETED = re.compile(rf"{_OPEN}\s*(?:at|dot|@|\.)\s*{_CLOSE}", re.I)
_WORD_FORM = re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]+(?:\s+dot\s+[A-Za-z0-9_%+-]+)*(\s+at\s+|\s*@\s*)[A-Za-z0-9-]+"
                        r"(?:(?:\s+dot\s+|\.)[A-Za-z0-9-]+)*\s+dot\s+[A-Za-z]{2,}(?!\w)"
                        r"|(?<![\w.%+-])[A-Za-z0-9._%+-]+(?:\s+dot\s+[A-Za-z0-9_%+-]+)*\s+at\s+[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", re.I)
_HAS_WORD_FORM = re.compile(r"\sdot\s|\sat\s+[A-Za-z0-9-]+\.[A-Za-z0-9-]", re.I)
_SPOKEN_SIGN = re.compile(r"\s+(at|dot)\s+|\s*@\s*", re.I)


def sign(m: re.Match) -> str:
    return {"at": "@", "dot": "."}.get((m.group(1) or "@").lower(), m.group(1) or "@")


def spoken(m: re.Match) -> str | None:
    """An address said with words; prose that merely holds "at" stays, since a
    dot must follow as a word, or the local part must carry a sign or digit."""
    whole = m.group()
    if not re.search(r"\sdot\s", whole, re.I) and not re.match(r"\S*[0-9._%+-]", whole):
        return None
    return _SPOKEN_SIGN.sub(sign, whole)


def steps(text: str):
    """The rewriting steps that a text calls for."""
    if _HAS_ODD.search(text):
        yield _ODD, lambda m: _ALIKE.get(m.group(), "")
    yield _SPELLED_RUN, spelled_digits
    yield _BRACKETED, sign
    yield _WORD_FORM, spoken


def disguised_spans(text: str) -> list[tuple[int, int, str]]:
    """Source spans of identifiers that only the rewritten text shows."""
    layers, now, out = [], text, {}
    gates = {_SPELLED_RUN: _HAS_SPELLED, _BRACKETED: _HAS_BRACKETED, _WORD_FORM: _HAS_WORD_FORM}
    for pattern, put in steps(text):
        gate = gates.get(pattern)
        if gate is not None and not gate.search(now):
            continue
        layer = rewrite(now, pattern, put)
        if layer is None:
            continue
        layers.append(layer)
        now = layer.text
        # after each step: what one step shows, the next may join to its neighbours
        for s, e, kind in plain_spans(now):
            touched = False
            for layer in reversed(layers):
                s, e, put_in = layer.source(s, e)
                touched |= put_in
            if touched:
                while s < e and text[s].isspace():
                    s += 1
                while e > s and text[e - 1].isspace():
                    e -= 1
                out[s, e, kind] = None
    return list(out)


class Cover:
    """Spans that no other covers: starts and ends both ascend."""

    def __init__(self):
        self.starts, self.ends = [], []

    def add(self, s: int, e: int) -> bool:
        """Takes the span in unless one before covers it; whether it did."""
        at = bisect_right(self.starts, s)
        if at and self.ends[at - 1] >= e:
            return False
        at = bisect_left(self.starts, s)
        stop = at
        while stop < len(self.ends) and self.ends[stop] <= e:
            stop += 1
        self.starts[at:stop], self.ends[at:stop] = [s], [e]
        return True


def spans(text: str | None) -> list[dict]:
    """All spans by start, then kind: plain ones, and disguised ones that no
    plain or earlier one of their kind covers."""
    if not text:
        return []
    plain, extra = plain_spans(text), []
    covers = {k: Cover() for k in KINDS}
    for s, e, k in plain:
        covers[k].add(s, e)
    for s, e, k in disguised_spans(text):
        if covers[k].add(s, e):
            extra.append((s, e, k))
    found = [(s, KINDS.index(k), e, k, True) for s, e, k in plain] + [(s, KINDS.index(k), e, k, False) for s, e, k in extra]
    return [{"kind": k, "start": s, "end": e, "plain": p} for s, _, e, k, p in sorted(found)]


def find(text: Column) -> Column:
    """Array of (kind, start, end, plain) structs; offsets in code points, end exclusive."""
    @F.pandas_udf(SPAN)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(spans)
    return run(text)


def masked_text(text: str | None) -> str | None:
    """The text with each span (joined where they overlap) replaced by its kind."""
    if not text:
        return text
    out, done = [], 0
    for sp in spans(text):
        if sp["end"] <= done:
            continue
        if sp["start"] >= done:
            out += [text[done:sp["start"]], f"[{sp['kind'].upper()}]"]
        done = sp["end"]
    return "".join(out) + text[done:] if out else text


def mask(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(masked_text)
    return run(text)


def listed(found: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(found, one), ",")


def query(spark, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", find(F.col("text")).alias("s"))
    plain = F.filter("s", lambda s: s["plain"])
    of_kind = lambda kind: lambda s: s["plain"] & (s["kind"] == kind)
    counts = [F.size(F.filter("s", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(plain).cast("binary"), 256).alias("base_sha256"), listed(F.col("s")).alias("spans"))
