"""One consistent form for text that looks the same but is stored with different characters."""

from __future__ import annotations

import re
import unicodedata as ud
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.runtime import pin_table

# Letters of other scripts that are drawn like a Latin letter.
CYRILLIC_LIKE = dict(zip("АВЕЅІЈКМНОРСТУХҮԌԚԜӀаеѕіјорсухһԁԛԝӏ", "ABESIJKMHOPCTYXYGQWIaesijopcyxhdqwl"))
GREEK_LIKE = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳονρϲ", "ABEZHIKMNOPTYXCjovpc"))
ARMENIAN_LIKE = dict(zip("ՍՏՕհոսցօ", "USOhnugo"))
COPTIC_LIKE = dict(zip("ⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲬⲟⲣⲥⲭ", "BHIKMNOPCTXopcx"))
CHEROKEE_LIKE = dict(zip("ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ", "ABCDEGHJKLMPRSTVWZ"))
LATIN_LIKE = dict(zip("ɡɑ", "ga"))

# Compatibility characters drawn like the letters they stand for (ligatures, digraphs,
# roman numerals, ideograph radicals); other compatibility characters such as the ellipsis look different.
COMPAT_RANGES = ((0x0132, 0x0133), (0x01C4, 0x01CC), (0x01F1, 0x01F3), (0x2160, 0x217F), (0x2E9F, 0x2EF3), (0x2F00, 0x2FD5), (0xFB00, 0xFB06), (0xFB13, 0xFB17))
WIDTH_TAGS = ("<wide>", "<narrow>", "<noBreak>", "<font>")

# Characters that show nothing (default-ignorable code points).
IGNORABLE_RANGES = ((0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0xE0000, 0xE0FFF))

#: In ASCII text, whatever is not a single space between two visible characters.
UNSETTLED_ASCII = r"[\x00-\x1f\x7f]|  |^ | $"


def _in(ranges, cp: int) -> bool:
    return any(a <= cp <= b for a, b in ranges)


@lru_cache(maxsize=1)
def _tables():
    """Per character replacements and the pattern of unstable segments, derived from the Unicode data."""
    fold: dict[int, str] = {}
    unstable: list[int] = []
    spaces = []
    for cp in [*range(0x80, 0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x10000), *range(0x10000, 0x1FFFF), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE1000)]:
        ch = chr(cp)
        if _in(IGNORABLE_RANGES, cp):
            fold[cp] = ""
            unstable.append(cp)
            continue
        if ch.isspace():
            spaces.append(cp)
            continue
        d = ud.decomposition(ch)
        if d.startswith(WIDTH_TAGS) or (d.startswith("<compat>") and _in(COMPAT_RANGES, cp)):
            out = ud.normalize("NFKC", ch)
            fold[cp] = " " if out.isspace() else out
            unstable.append(cp)
        elif ud.combining(ch) or not ud.is_normalized("NFC", ch):
            unstable.append(cp)
    unstable += range(0x1160, 0x1200)  # vowels and finals that compose with a syllable before them

    def runs(cps):
        out, begin, prev = [], None, None
        for cp in sorted(set(cps)):
            if begin is None:
                begin = prev = cp
            elif cp == prev + 1:
                prev = cp
            else:
                out.append((begin, prev))
                begin = prev = cp
        if begin is not None:
            out.append((begin, prev))
        return "".join(f"\\U{a:08x}" if a == b else f"\\U{a:08x}-\\U{b:08x}" for a, b in out)

    return fold, re.compile(f"[{runs(unstable)}]+")


def _splice(text: str) -> str:
    """Normalise the unstable runs, each with the character before it, with which its first mark may compose."""
    fold, unstable = _tables()
    out, done = [], 0
    for m in unstable.finditer(text):
        at = max(done, m.start() - 1)
        out.append(text[done:at])
        out.append(ud.normalize("NFC", text[at : m.end()].translate(fold)))
        done = m.end()
    if not out:
        return text
    out.append(text[done:])
    return "".join(out)


_SCRIPTS = {"CYRILLIC": CYRILLIC_LIKE, "GREEK": GREEK_LIKE, "ARMENIAN": ARMENIAN_LIKE, "COPTIC": COPTIC_LIKE, "CHEROKEE": CHEROKEE_LIKE}
_LIKE = {k: v for like in (*_SCRIPTS.values(), LATIN_LIKE) for k, v in like.items()}
# of two letters of one script that are drawn alike the first is used
_BACK = {name: {v: k for k, v in reversed(like.items()) if k not in "ҮԌԁԛԝӏӀһ"} for name, like in _SCRIPTS.items()}
_LATIN_SHARED = frozenset(_LIKE.values())
_FOREIGN = re.compile("[ɑɡͰ-֏Ꭰ-Ᏽⲁ-⳿Ⲁ]")
_WORD = re.compile(r"[^\W\d_]+")
_DECOMPOSED = {c: (ud.normalize("NFD", c)[0], ud.normalize("NFD", c)[1:]) for c in map(chr, [*range(0xC0, 0x250), *range(0x370, 0x530)])}


@lru_cache(maxsize=4096)
def _script(base: str) -> str:
    """The script a letter shows by itself; '' for letters that several scripts draw alike."""
    if base in _LIKE or base in _LATIN_SHARED:
        return ""
    name = ud.name(base, "")
    return next((s for s in ("LATIN", *_SCRIPTS) if name.startswith(s)), "OTHER")


def _bases(text: str) -> list[str]:
    return [_DECOMPOSED.get(c, (c, ""))[0] for c in text]


def _leading(bases: list[str]) -> str:
    n = dict.fromkeys(("LATIN", *_SCRIPTS), 0)
    for b in bases:
        s = _script(b)
        if s in n:
            n[s] += 1
    best = max(n.values())
    return "" if best == 0 else next(s for s in n if n[s] == best)


def _one_script(text: str) -> str:
    """Write every look-alike letter in the script its word shows by its other letters.

    The choice rests only on letters no other script draws alike, which equal-looking texts share, so
    equal-looking texts come out equal while Russian or Greek words keep their own letters. A word of
    look-alikes alone follows the script most of the whole text shows, Latin where nothing decides.
    """
    whole = None

    def word(m: re.Match) -> str:
        nonlocal whole
        w = m.group()
        bases = _bases(w)
        if all(b not in _LIKE and b not in _LATIN_SHARED for b in bases):
            return w
        script = _leading(bases)
        if not script:
            if whole is None:
                whole = _leading([b for x in _WORD.findall(text) for b in _bases(x)]) or "LATIN"
            script = whole
        back = _BACK.get(script, {})
        out = []
        for c, b in zip(w, bases):
            latin = _LIKE.get(b, b)
            target = back.get(latin, latin) if b in _LIKE or b in _LATIN_SHARED else b
            out.append(c if target == b else ud.normalize("NFC", target + _DECOMPOSED.get(c, (c, ""))[1]))
        return "".join(out)

    return _WORD.sub(word, text)


def canonical_text(text: str | None) -> str | None:
    """The consistent form of one text: null stays null, blank or invisible text becomes ''.

    Stable stretches are copied as they are. Only segments whose characters fail the quick check (not
    composed, folded by width, invisible) are normalised, together with the character before them, and
    spliced back. Blank space becomes single spaces, none at the ends. Case, accents and the shape of
    quotes and dashes stay.
    """
    if text is None:
        return None
    if not text.isascii():
        text = _splice(text)
        if not ud.is_normalized("NFC", text):  # a removed character had stood between a base and its mark
            text = ud.normalize("NFC", text)
        if _FOREIGN.search(text):
            text = ud.normalize("NFC", _one_script(text))
    return " ".join(text.split())


@F.arrow_udf(T.StringType())
def _canonical(values: pa.Array) -> pa.Array:
    return pa.array([canonical_text(v) for v in values.to_pylist()], pa.string())


def canonical(col: Column) -> Column:
    """`canonical_text` as a column. ASCII values with settled blanks stay in the JVM."""
    stable = (F.octet_length(col) == F.length(col)) & ~col.rlike(UNSETTLED_ASCII)
    return F.coalesce(_canonical(F.when(~stable, col)), col)


def canonicalise(df: DataFrame, columns: list[str]) -> DataFrame:
    """`df` with each of `columns` in its consistent form; other columns, whatever their names, are untouched."""
    return df.withColumns({c: canonical(F.col(c)) for c in columns})


def equal_looking_pairs(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """Pairs of rows whose value of a column looks the same but is not the same string.

    (field_name, a, b), a < b. Null and '' take no part; repeated rows pair with the variants only. The
    distinct variants of a form are paired first and rows join to them, so a form stored a million times
    in one way costs nothing: work follows the size of the result. The forms' fingerprints are written
    once, so the text is normalised once.
    """
    cells = df.select(F.col(id_col).alias("_id"), F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("v")) for c in columns])).alias("c"))
    cells = cells.select("_id", "c.field_name", "c.v").filter(F.col("v") != "")
    form = canonical(F.col("v"))
    rows = pin_table(cells.select("_id", "field_name", form.alias("form"), F.xxhash64("v").alias("v")).select(
        "_id", F.xxhash64(F.col("field_name"), F.col("form")).alias("k1"), F.xxhash64(F.lit(7), F.col("form"), F.col("field_name")).alias("k2"), "v", (F.array_position(F.array(*map(F.lit, columns)), F.col("field_name")) - 1).cast("tinyint").alias("f"),
    ))
    variants = rows.select("k1", "k2", "v").distinct()
    several = variants.groupBy("k1", "k2").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).filter("lo < hi").select("k1", "k2")
    variants = variants.join(several, ["k1", "k2"])
    pairs = variants.join(variants.withColumnRenamed("v", "w"), ["k1", "k2"]).filter("v < w")
    left = rows.join(pairs, ["k1", "k2", "v"]).select("k1", "k2", "w", "f", F.col("_id").alias("x"))
    both = left.join(rows.select("k1", "k2", F.col("v").alias("w"), F.col("_id").alias("y")), ["k1", "k2", "w"])
    name = F.element_at(F.array(*map(F.lit, columns)), F.col("f") + 1)
    return both.select(name.alias("field_name"), F.least("x", "y").alias(f"{id_col}_a"), F.greatest("x", "y").alias(f"{id_col}_b"))
