"""Problem 3: text that was decoded with a wrong encoding.

Noisy-channel decoding: stretches that may be garbled are proposed by what bytes they can stand for; each is turned back into those
bytes (a lattice in which lost bytes are wildcards), and a Viterbi search looks for the most likely text with those bytes in the
encoding they were written in, under the corpus's frequencies of words, characters and bigrams. A stretch is damaged if that text is
likelier than the stretch as it stands by more than a mistake costs; where all bytes are lost, if the stretch is less likely than
text that nobody can tell.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .neardup import _mix

#: Encodings a text may have been read in by mistake: one byte a character, and several.
SINGLE = ("cp1252", "mac_roman", "cp1251", "cp437", "cp850", "cp1250", "koi8_r")
MULTI = ("gb18030", "cp932", "big5", "euc_kr")
#: Slots of the bigram table, whatever the corpus's size.
SLOTS = 1 << 20
#: Characters below this share of the corpus's characters are not its own.
OWN_SHARE = 2e-7
#: What a mistake costs, a lost character that nobody can tell, and one that fits nowhere, as log likelihoods.
MISTAKE, UNTOLD, NOWHERE = -6.0, -7.0, -25.0
#: Occurrences of a word that make it one of the corpus's, and its share of all words (above what words share slots by accident).
KNOWN, KNOWN_SHARE = 3, 3e-6
#: Rows of the word table; a word counts as often as its least slot says.
WORD_ROWS = 3
#: A stretch that lost a greater share of its bytes is beyond recovery.
MOST_LOST = 0.3

_KUN = "锟斤拷"
#: Words of alphabets, and such with a character that another one-byte encoding may have put there.
_WORD = re.compile(r"[^\W\d_\u3400-\u9fff\u3040-\u30ff\uac00-\ud7a3]{2,}")
_MIXED = re.compile(r"[A-Za-z]*(?:[A-Za-z][\u0080-\u04ff\u2010-\u25ff]|[\u0080-\u04ff\u2010-\u25ff][A-Za-z])[A-Za-z\u0080-\u04ff\u2010-\u25ff]*")
#: Pairs of one-byte encodings, written and read.
SWAPPED = tuple((w, r) for w in ("cp1252", "mac_roman", "cp850") for r in ("cp1252", "mac_roman", "cp850", "cp437", "cp1250") if w != r)


@lru_cache(1)
def _rare_hanzi() -> str:
    """Ideographs outside the standard set of simplified Chinese, as ranges of a character class."""
    out, start = [], None
    for o in range(0x4E00, 0xA001):
        try:
            chr(o).encode("gb2312")
            rare = False
        except UnicodeEncodeError:
            rare = o < 0xA000
        if rare and start is None:
            start = o
        elif not rare and start is not None:
            out.append(f"{chr(start)}-{chr(o - 1)}")
            start = None
    return "".join(out)


@lru_cache(1)
def _suspect() -> re.Pattern:
    """What no clean text of the corpus's languages holds often: rows without it are not looked at any further."""
    rare = _rare_hanzi()
    cjk = r"\u4e00-\u9fff\u3000-\u303f\uff00-\uff65\uffa0-\uffef"
    marks = r"\u2010-\u2015\u2018-\u201e\u2026\u00b7\u2022\u00b0\u00b1\u00d7"
    return re.compile(
        rf"[\x80-\x9f\ufffd\ue000-\uf8ff\uff66-\uff9f]|锟|[^\x00-\x7f{cjk}{marks}]{{2}}|[\xc2-\xf4][{marks}]|[{rare}].{{0,3}}[{rare}]"
    )


@lru_cache(None)
def _bytes_of(encoding: str) -> dict[str, int]:
    """The characters of the upper half of a one-byte encoding; undefined bytes are C1 controls, as lenient decoders have it."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    if encoding == "cp1252":
        for b in range(0x80, 0xA0):
            out.setdefault(chr(b), b)
    return out


@lru_cache(None)
def _sequence(encoding: str) -> re.Pattern:
    """A UTF-8 sequence of two or three bytes, or a run of such, as read in a one-byte encoding."""
    of: dict[str, list[str]] = {"c": [], "2": [], "3": []}
    for ch, b in _bytes_of(encoding).items():
        kind = "c" if b < 0xC0 else "2" if 0xC2 <= b <= 0xDF else "3" if 0xE0 <= b <= 0xEF else None
        if kind:
            of[kind].append(re.escape(ch))
    c, two, three = ("".join(of[k]) for k in "c23")
    return re.compile(f"(?:[{two}][{c}]|[{three}][{c}][{c}])+")


@lru_cache(None)
def _broken(encoding: str) -> re.Pattern:
    """As _sequence, with lost bytes among them."""
    of: dict[str, list[str]] = {"c": ["�"], "2": [], "3": []}
    for ch, b in _bytes_of(encoding).items():
        kind = "c" if b < 0xC0 else "2" if 0xC2 <= b <= 0xDF else "3" if 0xE0 <= b <= 0xEF else None
        if kind:
            of[kind].append(re.escape(ch))
    c, two, three = ("".join(of[k]) for k in "c23")
    return re.compile(f"(?:[{two}][{c}]|[{three}][{c}][{c}]|�[{c}]{{1,2}})+")


@lru_cache(None)
def _run(encoding: str) -> re.Pattern:
    return re.compile("[" + "".join(re.escape(ch) for ch, b in _bytes_of(encoding).items() if b >= 0x81) + "]{4,}")


class Language:
    """Word, character and bigram frequencies of the corpus."""

    def __init__(self, chars: dict[int, int], slots: np.ndarray, words: np.ndarray | None = None):
        total = max(1, sum(chars.values()))
        self.own = {chr(o) for o, n in chars.items() if o > 0x7F and n >= max(2, OWN_SHARE * total)}
        self.logp = {chr(o): float(np.log(n / total)) for o, n in chars.items()}
        self.floor = float(np.log(0.1 / total))
        self.slots = slots
        self.counts = chars
        self.words = np.zeros((WORD_ROWS, SLOTS), np.float32) if words is None else words
        self.n_words = max(1.0, float(self.words[0].sum()))
        # what lost bytes may have been, by the bytes that are left; most frequent first
        self._compatible: dict[tuple, list[str]] = {}
        self._frequent = [chr(o) for o, _ in sorted(chars.items(), key=lambda x: -x[1]) if o > 0x7F and chr(o) in self.own]
        self._steps: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_compatible": {}, "_steps": {}}

    def step(self, before: str, ch: str) -> float:
        got = self._steps.get(before + ch)
        if got is None:
            uni = self.logp.get(ch, self.floor)
            got = uni
            if before:
                n = self.counts.get(ord(before), 0)
                pair = float(self.slots[pair_slot(ord(before), ord(ch))]) if n else 0.0
                got = float(np.log(max(1e-12, pair * 0.9 / max(1, n) + 0.1 * np.exp(uni))))
            if len(self._steps) < 1_000_000:
                self._steps[before + ch] = got
        return got

    def count(self, word: str) -> float:
        """How often the corpus has a word, as far as its slots tell; 0 if that is too seldom to say."""
        n = float(min(row[k] for row, k in zip(self.words, word_slots(word))))
        return n if n >= max(KNOWN, KNOWN_SHARE * self.n_words) else 0.0

    def score(self, text: str, before: str = "") -> float:
        """Log likelihood of a text: by its characters, and a word of the corpus by its frequency where that is likelier."""
        steps, last = [], before
        for ch in text:
            steps.append(NOWHERE if ch == "�" else self.step(last, ch))
            last = "" if ch == "�" else ch
        total = sum(steps)
        for m in _WORD.finditer(text):
            if n := self.count(m[0]):
                total += max(0.0, float(np.log(n / self.n_words)) - sum(steps[m.start() : m.end()]))
        return total

    def compatible(self, encoding: str, known: tuple) -> list[str]:
        """Own characters whose bytes agree with the known ones (None for a lost one)."""
        key = (encoding, known)
        if key not in self._compatible:
            out = []
            for ch in self._frequent:
                try:
                    b = ch.encode(encoding)
                except UnicodeEncodeError:
                    continue
                if len(b) == len(known) and all(k is None or k == x for k, x in zip(known, b)):
                    out.append(ch)
            self._compatible[key] = out
        return self._compatible[key]


def pair_slot(a: int, b: int) -> int:
    # _mix of one value, in plain integers
    h, low = a << 21 | b, 0xFFFFFFFFFFFFFFFF
    h = (h ^ (h >> 33)) * 0xFF51AFD7ED558CCD & low
    h = (h ^ (h >> 33)) * 0xC4CEB9FE1A85EC53 & low
    return (h ^ (h >> 33)) & (SLOTS - 1)


def word_slots(word: str) -> list[int]:
    """The word's slot in each row of the table."""
    data = word.lower().encode("utf-8", "surrogatepass")
    return [zlib.crc32(data, 0x9E3779B1 * row & 0xFFFFFFFF) * 0x9E3779B1 >> 7 & (SLOTS - 1) for row in range(WORD_ROWS)]


def _count(batches):
    """Counts of a partition's clean rows: (kind, key, n) with kind 0 for characters, 1 for bigram slots, 2 and on for word slots."""
    suspect = _suspect().search
    chars, slots, words = np.zeros(0x110000, np.int64), np.zeros(SLOTS, np.int64), np.zeros((WORD_ROWS, SLOTS), np.int64)
    for batch in batches:
        for part in common._slices(batch, 2000, 1_500_000, "text"):
            clean = "\n".join(t for t in part.column("text").to_pylist() if t and not suspect(t))
            if not clean:
                continue
            codes = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), np.uint32)
            chars += np.bincount(codes, minlength=0x110000)
            pairs = _mix(codes[:-1].astype(np.uint64) << np.uint64(21) | codes[1:].astype(np.uint64)) & np.uint64(SLOTS - 1)
            slots += np.bincount(pairs.astype(np.int64), minlength=SLOTS)
            for w, n in Counter(_WORD.findall(clean)).items():
                for row, k in enumerate(word_slots(w)):
                    words[row, k] += n
    for kind, table in enumerate((chars, slots, *words)):
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int64)), pa.array(table[at])], ["kind", "key", "n"])


def language_of(df: DataFrame) -> Language:
    """The frequencies of df's `text`. What reaches the driver has at most as many rows as there are code points and slots."""
    rows = df.select("text").mapInArrow(_count, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")).toArrow()
    kind, key, n = (rows.column(c).to_numpy() for c in ("kind", "key", "n"))
    slots, words = np.zeros(SLOTS, np.float32), np.zeros((WORD_ROWS, SLOTS), np.float32)
    slots[key[kind == 1]] = n[kind == 1]
    for row in range(WORD_ROWS):
        words[row, key[kind == 2 + row]] = n[kind == 2 + row]
    return Language(dict(zip(key[kind == 0].tolist(), n[kind == 0].tolist())), slots, words)


@dataclass
class Stretch:
    start: int
    end: int
    #: What it was, None where nothing can be told.
    text: str | None
    #: misread encoding > written encoding
    how: str


Lattice = list  # of byte values, None for a lost byte


def decode_lattice(lattice: Lattice, encoding: str, language: Language) -> tuple[str, float]:
    """The most likely text of the bytes in utf-8 or gbk, and its score; bytes that fit nowhere become U+FFFD.

    Exact under the bigrams: a state (the last character) is only given up if its lead over the best one can't be made good, as it
    counts for one step alone, which brings no more than 0 and costs no more than the rarest character after anything.
    """
    behind = float(np.log(0.1)) + language.floor
    n = len(lattice)
    beams: list[dict[str, tuple[float, str]]] = [{} for _ in range(n + 1)]
    beams[0][""] = (0.0, "")

    def put(at: int, ch: str, score: float, text: str) -> None:
        old = beams[at].get(ch)
        if old is None or old[0] < score:
            beams[at][ch] = (score, text)

    for i in range(n):
        if not beams[i]:
            continue
        top = max(x[0] for x in beams[i].values())
        states = [x for x in beams[i].items() if x[1][0] >= top + behind]
        beams[i] = {}
        options: list[tuple[int, str, float]] = []
        b = lattice[i]
        if b is not None and b < 0x80:
            options.append((1, chr(b), 0.0))
        else:
            sizes = (2, 3) if encoding == "utf-8" else (2,)
            for size in sizes:
                lead_ok = b is None or (0xC2 <= b <= 0xDF if size == 2 else 0xE0 <= b <= 0xEF) if encoding == "utf-8" else b is None or b >= 0x81
                if not lead_ok:
                    continue
                known = tuple(lattice[i : i + size])
                # bytes that were dropped without a trace: before plain text or at the end
                gone = 0
                while len(known) - gone > 1 and (k := known[len(known) - gone - 1]) is not None and encoding == "utf-8" and not 0x80 <= k <= 0xBF:
                    gone += 1
                cut = known[: len(known) - gone]
                missing = size - len(cut)
                full = (*cut, *[None] * missing)
                if None not in full:
                    try:
                        ch = bytes(full).decode(encoding)
                    except UnicodeDecodeError:
                        continue
                    if len(ch) == 1:
                        options.append((size, ch, 0.0))
                elif all(x is None for x in full):
                    options.append((size - missing, "�", NOWHERE))  # one character that nobody can tell
                else:
                    cost = -2.0 * missing
                    options.extend((size - missing, c, cost) for c in language.compatible(encoding, full))
        options.append((1, "�", NOWHERE))
        for size, ch, cost in options:
            for before, (score, text) in states:
                put(i + size, ch, score + cost + (0.0 if ch == "�" else language.step(before if before != "�" else "", ch)), text + ch)
    score, text = max(beams[n].values())
    return text, score


def _lattice(span: str, encoding: str) -> Lattice:
    if encoding in SINGLE:
        table = _bytes_of(encoding)
        return [ord(c) if c < "\x80" else table.get(c) for c in span]
    out: Lattice = []
    for c in span:
        if c == "�":
            out.append(None)
            continue
        try:
            out.extend(c.encode(encoding))
        except UnicodeEncodeError:
            out.append(None)
    return out


def _utf8_spans(line: str, encoding: str, own: set) -> list[tuple[int, int, int]]:
    """(start, end, sequences) of a line's parts whose bytes are UTF-8 sequences that give own characters.

    Plain characters and lost bytes may stand between two runs, and a few others; a part reaches over the lost characters after it.
    """
    data: Lattice = []
    at: list[int] = []
    for i, c in enumerate(line):
        part = _lattice(c, encoding)
        data.extend(part)
        at.extend([i] * len(part))
    runs: list[list[int]] = []
    i, n, open_ = 0, len(data), False
    while i < n:
        b = data[i]
        if b is not None and 0xE0 <= b <= 0xEF and i + 2 < n:
            x, y = data[i + 1], data[i + 2]
            if x is not None and y is not None and 0x80 <= x <= 0xBF and 0x80 <= y <= 0xBF:
                try:
                    good = bytes((b, x, y)).decode() in own
                except UnicodeDecodeError:
                    good = False
                if good:
                    if open_:
                        runs[-1][1] = i + 3
                        runs[-1][2] += 1
                    else:
                        runs.append([i, i + 3, 1])
                    open_ = True
                    i += 3
                    continue
            elif (x is None or 0x80 <= x <= 0xBF) and (y is None or 0x80 <= y <= 0xBF):
                i += 3
                continue
        elif b is None or b < 0x80:
            i += 1
            continue
        open_ = False
        i += 1
    merged: list[list[int]] = []
    for r in runs:
        if merged and (r[0] - merged[-1][1] <= 8 or all(b is None or b < 0x80 for b in data[merged[-1][1] : r[0]])):
            merged[-1][1] = r[1]
            merged[-1][2] += r[2]
        else:
            merged.append(list(r))
    out = []
    for x, y, k in merged:
        if k < 2:
            continue
        start, end = at[x], at[y - 1] + 1
        while end < len(line) and _odd().match(line[end]):
            end += 1
        out.append((start, end, k))
    return out


def _reads(span: str, encoding: str, to: str) -> bool:
    """Whether a span's bytes are whole text in another encoding."""
    data = _lattice(span, encoding)
    try:
        return None not in data and bool(bytes(data).decode(to))
    except UnicodeDecodeError:
        return False


def _gbk_share(data: Lattice, own: set) -> tuple[int, float]:
    """(own ideographs, their share) if the bytes are read in pairs; the better of the two ways to pair them."""
    best = (0, 0.0)
    raw = bytes(b if b is not None else 0x3F for b in data)
    for at in (0, 1):
        text = raw[at:].decode("gbk", "ignore")
        own_n = sum(c in own for c in text)
        high = sum(c > "\x7f" for c in text)
        best = max(best, (own_n, own_n / max(1, high)))
    return best


@lru_cache(1)
def _odd() -> re.Pattern:
    """Characters that garbled Chinese is full of: rare ideographs, half-width kana, Hangul, lost and private ones."""
    return re.compile(rf"[{_rare_hanzi()}\uff66-\uff9f\uac00-\ud7a3\ufffd\ue000-\uf8ff]")


_CYRILLIC = re.compile("[Ѐ-ӿ]")


def _own(text: str, own: set) -> bool:
    return sum(c in own for c in text) >= max(1, 0.7 * len(text))


def find_stretches(text: str, language: Language) -> list[Stretch]:
    """The damaged stretches of a text with what they were, in order and without overlap."""
    if not text:
        return []
    return [x for x in (_judged(text, x, language) for x in proposals(text, language)) if x]


def _judged(text: str, x: Stretch, language: Language) -> Stretch | None:
    """The stretch with its most likely text if that is likelier than the stretch as it stands, None if not."""
    span = text[x.start : x.end]
    got = _restored(span, x.how, language)
    if got is None or got == span or got.count("�") > span.count("�") > 0:
        got = None
        # nothing can be told: only what isn't the corpus's own speaks for a mistake
        odd = [c for c in span if c > "\x7f" and (c not in language.own or c in _KUN)]
        gain = sum(UNTOLD - language.logp.get(c, language.floor) for c in odd)
    else:
        before = text[x.start - 1] if x.start else ""
        gain = language.score(got, before) - language.score(span, before)
    return Stretch(x.start, x.end, got, x.how) if gain + MISTAKE > 0 else None


def _swapped(text: str, language: Language) -> list[Stretch]:
    """Words that are none of the corpus's, but are with their bytes read in another one-byte encoding."""
    out = []
    for m in _MIXED.finditer(text):
        if m[0].isascii() or language.count(m[0]):
            continue
        best = (0.0, None)
        for written, read in SWAPPED:
            table = _bytes_of(read)
            try:
                got = bytes(ord(c) if c < "\x80" else table[c] for c in m[0]).decode(written)
            except (KeyError, UnicodeDecodeError):
                continue
            if got != m[0] and got.isalpha() and (n := language.count(got)) > best[0]:
                best = (n, f"{read}>{written}")
        if best[1]:
            out.append(Stretch(m.start(), m.end(), None, best[1]))
    return out


def proposals(text: str, language: Language) -> list[Stretch]:
    """Stretches that may be damaged, by what bytes they can stand for; text None, in order and without overlap."""
    swapped = _swapped(text, language)
    if not _suspect().search(text):
        return swapped
    own, out = language.own, swapped
    for enc in SINGLE:
        table = _bytes_of(enc)
        for m in _sequence(enc).finditer(text):
            got, twice = bytes(table[c] for c in m[0]).decode("utf-8", "replace"), ""
            if not _own(got, own):
                # read wrongly a second time
                got, twice = _sequence(enc).sub(lambda x: bytes(table[c] for c in x[0]).decode("utf-8", "replace"), got), ">"
            if not _own(got, own) or got == m[0]:
                continue
            if len(got) == 1 and enc in ("cp1251", "koi8_r") and _CYRILLIC.match(text, m.start() - 1):
                continue  # the end of a Russian word
            if len(got) == 1 and enc != "cp1252" and not got.isprintable():
                continue  # a letter before a soft hyphen or a fixed space
            out.append(Stretch(m.start(), m.end(), None, f"{enc}>utf-8{twice}"))
        if "�" in text:
            # with lost bytes among them a run is one stretch; what is there of it must be such sequences
            for m in _broken(enc).finditer(text):
                if "�" in m[0] and (n := sum(len(x[0]) for x in _sequence(enc).finditer(m[0]))) >= 2 and n >= 0.3 * len(m[0]):
                    out.append(Stretch(m.start(), m.end(), None, f"{enc}>utf-8"))
        upto = 0
        for m in _run(enc).finditer(text):
            if m.start() < upto:
                continue
            n, share = _gbk_share(_lattice(m[0], enc), own)
            if n >= 3 and share >= 0.7 and sum(c in own for c in m[0]) < 0.8 * len(m[0]):
                # second bytes may look like plain letters: as far as the line goes on that way
                end = m.end()
                for more in _run(enc).finditer(text, m.end(), (text + "\n").index("\n", m.end())):
                    between = text[end : more.start()]
                    if not between.isascii() or len(between) > 40 or not _reads(text[m.start() : more.end()], enc, "gbk"):
                        break
                    end = more.end()
                if end < len(text) and not _reads(text[m.start() : end], enc, "gbk") and _reads(text[m.start() : end + 1], enc, "gbk"):
                    end += 1
                upto = end
                out.append(Stretch(m.start(), end, None, f"{enc}>gbk"))
    for line in re.finditer(r"[^\n]+", text):
        s = line[0]
        rare = sum(1 for _ in _odd().finditer(s))
        if rare >= 2:
            for enc in MULTI:
                spans = _utf8_spans(s, enc, own)
                if spans and (max(k for *_, k in spans) >= 3 or sum(b - a for a, b, _ in spans) <= 3 * rare):
                    out.extend(Stretch(line.start() + a, line.start() + b, None, f"{enc}>utf-8") for a, b, _ in spans)
                    break
    # what has lost bytes and is no part of the above: as far as plain and strange characters go
    taken = sorted((x.start, x.end) for x in out)
    strange = lambda c: c != "\n" and (c < "\x80" or c == "�" or c not in own or c in _KUN)
    upto = 0
    for m in re.finditer("�|锟斤|斤拷|拷锟", text):
        if m.start() < upto or any(a <= m.start() < b for a, b in taken):
            continue
        a, b = m.start(), m.end()
        while a > upto and strange(text[a - 1]):
            a -= 1
        while b < len(text) and strange(text[b]):
            b += 1
        low, high = max((y for _, y in taken if y <= m.start()), default=0), min((x for x, _ in taken if x >= m.end()), default=len(text))
        upto = min(b, high)
        out.append(Stretch(max(a, low), upto, None, "lost" if _KUN[:2] in text[a:b] or _KUN[1:] in text[a:b] else "utf-8>gbk"))
    out.sort(key=lambda x: (x.start, -x.end))
    kept: list[Stretch] = []
    for x in out:
        if kept and x.start < kept[-1].end:
            continue
        kept.append(x)
    return kept


def _restored(span: str, how: str, language: Language) -> str | None:
    if how == "lost" or _KUN in span:
        return None
    enc, to, *again = how.split(">")
    if again:
        table = _bytes_of(enc)
        span = bytes(table[c] for c in span).decode("utf-8", "replace")
    if enc == "utf-8":
        # bytes that were valid UTF-8 by chance are still there, the others are lost
        data: Lattice = []
        for c in span:
            data.extend([None] if c == "�" else c.encode())
    else:
        data = _lattice(span, enc)
    lost = sum(x is None for x in data)
    if lost > MOST_LOST * len(data):
        return None
    if to in SINGLE:
        return None if lost else bytes(data).decode(to, "replace")
    if not lost:
        try:
            return bytes(data).decode(to)
        except UnicodeDecodeError:
            pass
    text, _ = decode_lattice(data, to, language)
    return text if text.count("�") <= 0.2 * len(text) else None


def restore(text: str | None, language: Language) -> tuple[str | None, int, int]:
    """(text with its damaged stretches restored where that can be told, damaged stretches, restored ones); null stays null."""
    if not text:
        return text, 0, 0
    parts, at, n, done = [], 0, 0, 0
    for x in find_stretches(text, language):
        n += 1
        got = x.text
        parts.append(text[at : x.start])
        parts.append(text[x.start : x.end] if got is None else got)
        done += got is not None
        at = x.end
    return "".join((*parts, text[at:])), n, done


def readable(line: str) -> str:
    """A line as it was if all of it was decoded wrongly and its bytes read well in one other way; else the line itself.

    For looking at lines one by one, where no language is at hand: only a reading of the whole line counts.
    """
    if line.isascii() or not _suspect().search(line):
        return line
    for enc in SINGLE:
        table = _bytes_of(enc)
        data = bytes(b for c in line if (b := ord(c) if c < "\x80" else table.get(c, 0)))
        if len(data) != len(line):
            continue
        for to in ("utf-8", "gbk") if enc == "cp1252" else ("utf-8",):
            try:
                got = data.decode(to)
            except UnicodeDecodeError:
                continue
            # plain characters stay what they are in any reading
            if len(got) < len(line) and sum(c < "\x80" for c in got) == sum(c < "\x80" for c in line) and (to == "utf-8" or sum("一" <= c <= "鿿" for c in got) >= 0.5 * sum(c > "\x7f" for c in got)):
                return got
    if len(_odd().findall(line)) >= 2:
        for enc in MULTI:
            try:
                got = line.replace("�", "?").encode(enc).decode("utf-8", "replace")
            except UnicodeEncodeError:
                continue
            if got.count("�") <= 0.2 * len(got):
                return got
    return line


def garbled(df: DataFrame, language: Language | None = None) -> DataFrame:
    """(tab, rec_id, n_stretches, n_restored, text) of the rows of df's (tab, rec_id, text) with a damaged stretch.

    Null and empty texts are never damaged. The language is that of df's clean rows if none is given.
    """
    rows = df.select("tab", "rec_id", "text")
    language = language or language_of(rows)

    def run(part: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("tab", "rec_id", "n_stretches", "n_restored", "text")}
        for tab, rec, t in zip(part["tab"], part["rec_id"], part["text"]):
            text, n, done = restore(t, language)
            if n:
                for k, v in zip(out, (tab, rec, n, done, text)):
                    out[k].append(v)
        return out

    return common.map_batches(rows, run, "tab string, rec_id long, n_stretches int, n_restored int, text string")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tab, rec_id) of the rows with a damaged stretch."""
    df = common.texts(spark, sf_dir)
    language = language_of(df)

    def run(part: dict) -> dict:
        rows = [i for i, t in enumerate(part["text"]) if find_stretches(t, language)]
        return {"tab": [part["tab"][i] for i in rows], "rec_id": [part["rec_id"][i] for i in rows]}

    return common.map_batches(df, run, "tab string, rec_id long")


def p3_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tab, rec_id, n_stretches, n_restored, text): the damaged rows with what could be restored."""
    return garbled(common.texts(spark, sf_dir))


QUERIES = {"p3_found": p3_found, "p3_restored": p3_restored}
