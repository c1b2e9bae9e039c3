"""Problem 7: one form for all texts that look alike.

Per token the script sets that could spell it are intersected: every letter offers the scripts in which its shape exists, a token's
consistent scripts are what all its letters offer. A token with one is respelled in it (Latin first), so mixed and whole-script
look-alikes meet; a token with none falls back to the Latin shape letter by letter. Which letters share a shape, and the scripts of
every letter, come from the public Unicode data (confusables and script extensions) in the library that Spark ships. Around
that: width, ligature, radical and compatibility-ideograph variants are decomposed, accents composed, invisible signs
removed, spaces reduced. Case, line breaks and raised, lowered, circled or otherwise drawn signs stay.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_right
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from . import common

# Letters with the shape of a Latin one, by script; the two strings of a script pair up. For looking at single lines
# where no session is at hand; results use the public tables.
SHAPES = {
    "Cyrl": (
        "АВСЕНІЈКМОРЅТХУҮѴԌԚԜӀаеіјорсухѕѵԁһԛԝӏ",
        "ABCEHIJKMOPSTXYYVGQWIaeijopcyxsvdhqwl",
    ),
    "Grek": (
        "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳονρϲ",
        "ABEZHIKMNOPTYXCjovpc",
    ),
    "Armn": (
        "ՏՍՕօոսհց",
        "SUOonuhg",
    ),
    "Cher": (
        "ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ",
        "ABCDEGHJKLMPRSTVWZ",
    ),
}
# Punctuation of one shape.
SIGNS = {"‐": "-", "‑": "-"}
#: Edges of one form that go to one task.
ROWS_A_TASK = 5000

#: Scripts whose signs are no letters of alphabets, and those that a token is spelled in first.
_NO_ALPHABET = ("Hani", "Hira", "Kana", "Hang", "Bopo", "Zyyy", "Zinh", "Zzzz", "Yiii", "Tang", "Nshu", "Kits")
_FIRST = ("Latn", "Cyrl", "Grek")
_SPACES = re.compile(r"[^\S\n]+")
_EDGES = re.compile(r"(?m)^ | $")


class Shapes:
    """Letters by shape, and the scripts of letters. Small and picklable: it travels with the tasks that use it."""

    def __init__(self, classes: list[dict[str, list[str]]], ranges: dict[str, list[tuple[int, int]]]):
        """classes: by script, the letters of one shape; ranges: the code points of each script, extensions included."""
        self.scripts = [s for s in (*_FIRST, *sorted(ranges)) if s in ranges]
        self.scripts = list(dict.fromkeys(self.scripts))
        self.of: dict[str, int] = {}
        self.by_script: list[dict[str, str]] = []
        for letters in classes:
            for own in letters.values():
                for ch in own:
                    self.of[ch] = len(self.by_script)
            self.by_script.append({script: own[0] for script, own in letters.items()})
        edges = sorted({x for r in ranges.values() for a, b in r for x in (a, b + 1)})
        sets: list[set] = [set() for _ in edges]
        for script, own in ranges.items():
            for a, b in own:
                for k in range(bisect_right(edges, a) - 1, bisect_right(edges, b)):
                    sets[k].add(script)
        self.edges, self.sets = edges, [frozenset(x) for x in sets]
        used = {script for letters in self.by_script for script in letters} - {"Latn", *_NO_ALPHABET}
        self.latin, self.others = ranges.get("Latn", []), sorted(r for script in used for r in ranges.get(script, ()))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def scripts_of(self, ch: str) -> frozenset:
        k = bisect_right(self.edges, ord(ch)) - 1
        return self.sets[k] if k >= 0 else frozenset()

    def patterns(self) -> tuple[re.Pattern, re.Pattern]:
        """(a letter that isn't plainly Latin, a token of letters and accents)."""
        if "_patterns" not in self.__dict__:
            one = lambda pairs: "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in pairs)
            other = [*self.others, *((ord(ch), ord(ch)) for ch in sorted(self.of) if ch > "\x7f")]
            # extensions hold accents and signs that any script has
            other = [(a, b) for a, b in other if not any(unicodedata.combining(chr(o)) for o in (a, b)) and b > 0x7F]
            self._patterns = re.compile(f"[{one(other)}]" if other else r"(?!)"), re.compile(f"[{one([*self.latin, *self.others, (0x300, 0x36F)])}]+")
            self._known: dict[str, str] = {}
        return self._patterns

    def respell(self, token: str) -> str:
        """The token (accents apart from their letters) in the first script that all its letters exist in."""
        got = self._known.get(token) if "_known" in self.__dict__ else None
        if got is not None:
            return got
        shapes = [self.of.get(ch) for ch in token]
        out = token
        if not token.isascii():
            able = None
            for ch, k in zip(token, shapes):
                if unicodedata.combining(ch):
                    continue
                offers = self.scripts_of(ch) if k is None else self.by_script[k].keys()
                able = set(offers) if able is None else able & offers
            script = next((x for x in self.scripts if x in (able or ())), None)
            # none spells all of it: the Latin shape, or the first there is
            fall = lambda k: next(self.by_script[k][x] for x in self.scripts if x in self.by_script[k])
            # a letter of the script stays as it is; only Latin has whole blocks of other shapes of its letters
            stays = lambda ch, k: k is None or script and script != "Latn" and script in self.scripts_of(ch)
            out = "".join(ch if stays(ch, k) else self.by_script[k].get(script, ch) if script else fall(k) for ch, k in zip(token, shapes))
        if "_known" in self.__dict__ and len(self._known) < 50_000:
            self._known[token] = out
        return out


@lru_cache(1)
def fixed_shapes() -> Shapes:
    """The fixed table above."""
    by: dict[str, dict[str, list[str]]] = {}
    for script, (own, to) in SHAPES.items():
        for ch, latin in zip(own, to):
            by.setdefault(latin, {"Latn": [latin]}).setdefault(script, []).append(ch)
    ranges = {"Latn": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)], "Grek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)], "Cyrl": [(0x400, 0x52F)], "Armn": [(0x531, 0x587)], "Cher": [(0x13A0, 0x13F5)]}
    return Shapes(list(by.values()), ranges)


_public: dict[str, Shapes] = {}


def public_shapes(spark: SparkSession) -> Shapes:
    """Shapes from the Unicode data of the library that Spark ships, read once a process.

    Letters are of one shape if they have one skeleton of one letter and one case; letters of no case take the skeleton's. Variants of
    a letter that are used beside it (their other case is plain ASCII) and letters that decompose are left out, and so are Latin
    letters of a shape that ASCII does not have: they are drawn differently on purpose.
    """
    icu = spark._jvm.com.ibm.icu
    version = icu.util.VersionInfo.ICU_VERSION.toString()
    if version in _public:
        return _public[version]
    ranges: dict[str, list[tuple[int, int]]] = {}
    for i in range(icu.lang.UScript.CODE_LIMIT):
        script = icu.lang.UScript.getShortName(i)
        # twice the complement is the set itself, as ranges
        found = _ranges(icu.text.UnicodeSet(f"[:scx={script}:]").complement().complement().toPattern(True))
        if found:
            ranges[script] = found
    letters = [chr(o) for script, own in ranges.items() if script not in _NO_ALPHABET for a, b in own for o in range(a, b + 1) if unicodedata.category(chr(o)) in ("Lu", "Ll", "Lo")]
    letters = sorted({ch for ch in letters if not unicodedata.decomposition(ch) and (ch.isascii() or not (ch.upper().isascii() or ch.lower().isascii()))})
    looks = icu.text.SpoofChecker.Builder().build().getSkeleton("\n".join(letters)).split("\n")
    ranged = Shapes([], ranges)
    by: dict[tuple[str, str], dict[str, list[str]]] = {}
    for ch, look in zip(letters, looks):
        if len(look) == 1 and look.isalpha():
            kind = unicodedata.category(ch)
            kind = unicodedata.category(look) if kind == "Lo" else kind
            for script in sorted(ranged.scripts_of(ch) - set(_NO_ALPHABET)):
                by.setdefault((look, kind), {}).setdefault(script, []).append(ch)
    classes = []
    for own in by.values():
        if not any(ch.isascii() for ch in own.get("Latn", ())):
            own.pop("Latn", None)
        # the plain letter stands for its script
        own = {script: sorted(set(x), key=lambda ch: (not ch.isascii(), ch)) for script, x in own.items()}
        if len({ch for x in own.values() for ch in x}) > 1:
            classes.append(own)
    _public[version] = Shapes(classes, ranges)
    return _public[version]


def _ranges(pattern: str) -> list[tuple[int, int]]:
    """Code point ranges of a set written with escapes for all that isn't ASCII."""
    one = r"\\U[0-9A-Fa-f]{8}|\\u[0-9A-Fa-f]{4}|\\.|[^\\\[\]\-]"
    point = lambda x: int(x[2:], 16) if x[:2] in ("\\U", "\\u") else ord(x[-1])
    return [(point(a), point(b or a)) for a, b in re.findall(f"({one})(?:-({one}))?", pattern)]


def _plain(ch: str) -> str | None:
    """What a variant of a character decomposes to, None if it stays, '' if it shows nothing."""
    o, kind = ord(ch), unicodedata.category(ch)
    if ch == "\n":
        return None
    if kind == "Zs" or ch in "\t\v\f":
        return " "
    if kind == "Cf" or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF or o in (0x034F, 0x115F, 0x1160, 0x3164, 0xFFA0, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D):
        return ""
    if ch in SIGNS:
        return SIGNS[ch]
    parts = unicodedata.decomposition(ch).split()
    if not parts or not parts[0].startswith("<"):
        return None  # canonical ones are left to NFC
    tag, to = parts[0], "".join(chr(int(x, 16)) for x in parts[1:])
    same = tag in ("<wide>", "<narrow>", "<initial>", "<medial>", "<final>", "<isolated>", "<vertical>", "<small>") or (
        tag == "<compat>"
        and (
            o == 0xB5  # micro
            or 0x132 <= o <= 0x133
            or 0x1C4 <= o <= 0x1CC
            or 0x1F1 <= o <= 0x1F3  # digraphs
            or 0x2160 <= o <= 0x217F  # Roman numerals
            or 0x2E80 <= o <= 0x2FD5  # radicals
            or 0x3131 <= o <= 0x318E  # Hangul letters
            or 0xFB00 <= o <= 0xFB17  # ligatures
        )
    )
    if not same or not to.strip():
        return None
    return "".join(ch if (p := _plain(ch)) is None else p for ch in to)


@lru_cache(1)
def _table() -> dict[int, str]:
    t = {o: p for o in range(0x80, sys.maxunicode + 1) if not 0xAC00 <= o <= 0xDFFF and not 0x4E00 <= o <= 0x9FFF and (p := _plain(chr(o))) is not None}
    return t | {9: " ", 11: " ", 12: " "}


@lru_cache(1)
def _touched() -> re.Pattern:
    """One class of all characters of the table, so that texts and stretches without any are not walked in Python."""
    points, runs = sorted(_table()), []
    for o in points:
        if runs and runs[-1][1] == o - 1:
            runs[-1][1] = o
        else:
            runs.append([o, o])
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) + "]")


def one_form(text: str | None, shapes: Shapes | None = None) -> str | None:
    """The common form of all texts that look like this one; null stays null, empty stays empty. Idempotent.

    shapes: which letters look alike, the fixed table if none are given.
    """
    if not text:
        return text
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    if not text.isascii():
        table, shapes = _table(), shapes or fixed_shapes()
        text = _touched().sub(lambda m: table[ord(m[0])], text)
        other, token = shapes.patterns()
        if other.search(text):
            text = token.sub(lambda m: shapes.respell(m[0]), unicodedata.normalize("NFD", text))
        text = unicodedata.normalize("NFC", text)
    return _EDGES.sub("", _SPACES.sub(" ", text))


def normalize_lookalikes(df: DataFrame, text: str = "text", out: str = "form") -> DataFrame:
    """df with column `out`: one_form of column `text`. Other columns, rows and nulls stay; a column named `out` is replaced."""
    shapes = public_shapes(df.sparkSession)

    @arrow_udf("string")
    def form(x: pa.Array) -> pa.Array:
        return pa.array([one_form(s, shapes) for s in x.to_pylist()], pa.string())

    return df.withColumn(out, form(F.col(text)))


def look_keys(df: DataFrame) -> DataFrame:
    """(tab, rec_id, raw, look): 128-bit keys of a text and of its common form, for (tab, rec_id, text)."""
    shapes = public_shapes(df.sparkSession)

    def keyed(part: dict) -> dict:
        h = lambda s: blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        return {"tab": part["tab"], "rec_id": part["rec_id"], "raw": [h(s) for s in part["text"]], "look": [h(one_form(s, shapes)) for s in part["text"]]}

    return common.map_batches(df, keyed, "tab string, rec_id long, raw binary, look binary")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tab, id_a, id_b): rows of one table that look the same but differ in characters. Blank texts are no cases.

    Only forms with two raw texts or more go on to the pairing join; one of many rows is paired in several tasks.
    """
    rows = look_keys(common.texts(spark, sf_dir).where(F.col("text").rlike(r"(?U)\S")))
    keyed = common.materialize(rows)
    several = keyed.groupBy("tab", "look").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"), F.ceil(F.count("*") / ROWS_A_TASK).cast("int").alias("parts")).where("lo <> hi").select("tab", "look", "parts")
    cases = keyed.join(several, ["tab", "look"])
    a = cases.select("tab", "look", F.col("rec_id").alias("id_a"), F.col("raw").alias("raw_a"), F.pmod(F.xxhash64("rec_id"), F.col("parts")).cast("int").alias("part"))
    b = cases.select("tab", "look", F.col("rec_id").alias("id_b"), F.col("raw").alias("raw_b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return a.join(b, ["tab", "look", "part"]).where("id_a < id_b AND raw_a <> raw_b").select("tab", "id_a", "id_b")


def p7_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tab, rec_id, class_id, n_rows, n_spellings): every non-null row with the least id of the rows that look like it. Linear in the rows."""
    keyed = common.materialize(look_keys(common.texts(spark, sf_dir)))
    per = keyed.groupBy("tab", "look", "raw").agg(F.min("rec_id").alias("first"), F.count("*").alias("n"))
    cls = per.groupBy("tab", "look").agg(F.min("first").alias("class_id"), F.sum("n").alias("n_rows"), F.count("*").alias("n_spellings"))
    return keyed.join(cls, ["tab", "look"]).select("tab", "rec_id", "class_id", "n_rows", "n_spellings")


QUERIES = {"p7_found": p7_found, "p7_classes": p7_classes}
