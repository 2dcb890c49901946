"""Template residue, filler, error pages and browser notices in the place of content."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from http import HTTPStatus

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import boilerplate
from newsloom.runtime import pin_table

# How template languages write a variable.
PLACEHOLDERS = [
    r"\{\{\{?\s*[\w.\-| ]+\s*\}?\}\}",
    r"\{%-?\s*\w+[^%{}]*%\}",
    r"[$#]\{\s*[\w.\-]+\s*\}",
    r"<%[=\-]?\s*[\w.\->()$]+\s*[;]?\s*%>",
    r"<\?(?:php|=)\s.*?\?>",
    r"\[\[\s*[\w.\- ]+\s*\]\]",
    r"%%[A-Z][A-Z0-9_]*%%",
    r"&&[\w.]+&&",
    r"\b__[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)*__",
    r"\[(?:INSERT|ENTER|ADD|YOUR|TYPE|PUT)\b[^\]a-z]*\]",
    r"\{[a-z]+(?:_[a-z]+)+\}",
    r"\[object Object\]",
]
# What servers, browser checks and unfinished pages say, by kind.
ERRORS = r"""
access denied|gateway time-?out|service temporarily unavailable|page not found|no longer available\b|link appears to be broken|could not be found|went wrong on our side|something went wrong|error code: ?\d+|page cannot be displayed
ist vorübergehend nicht erreichbar|seite nicht gefunden|zugriff verweigert|fehler aufgetreten|interner serverfehler
momentanément indisponible|page introuvable|accès refusé|une erreur est survenue|erreur interne
acceso denegado|página no encontrada|temporalmente no disponible|servicio no disponible|ha ocurrido un error|se ha producido un error|error interno
страница не найдена|доступ запрещ|временно недоступ|произошла ошибка|ошибка сервера
页面不存在|内容已被删除|服务器开小差|访问过于频繁|暂时无法访问|拒绝访问|服务不可用|服务器错误|网关超时
"""
NOTICES = r"""
enable javascript|javascript is (?:not available|disabled|required|turned off)|scripts turned on|checking your browser|verify (?:that )?you(?: are|'re) (?:a )?human|supported browser|requires javascript|complete the captcha
javascript aktivieren|aktivieren sie (?:bitte )?javascript|browser wird geprüft|bestätigen sie, dass sie ein mensch
activez javascript|activer javascript|vérifi\w+ (?:de )?votre navigateur|vous êtes humain
active javascript|activa javascript|habilite javascript|comprobando (?:su|tu) navegador|eres humano|es usted humano
включите javascript|проверка браузера|проверяем (?:ваш )?браузер|вы не робот
启用 ?javascript|不支持脚本|安全验证|正在检查您的浏览器|人机验证|开启脚本
"""
FILLERS = r"""
^\W*lorem ipsum|text goes here|copy to follow|^\W*(?-i:TODO)\b|placeholder text|dummy text|sample text|sample paragraph|content coming soon|insert text
hier steht später|blindtext|platzhaltertext|text folgt
texte à venir|faux texte|texte de remplissage
texto de relleno|texto de ejemplo|aquí va el texto
здесь будет текст|текст появится|текст-заполнитель|рыба-текст|тестовый текст
测试文章|此处填写|占位文字|此处为正文|正文待补
"""
DEFAULTS = r"^(?:undefined|null|none|nan|n/a|tbd|xxx+|test)$"


def _joined(block: str) -> str:
    return "|".join(x for x in block.strip().splitlines())


_PLACEHOLDER = re.compile("|".join(PLACEHOLDERS))
_REASONS = "|".join(re.escape(s.phrase) for s in HTTPStatus if s >= 400)
_REASON = re.compile(rf"(?i)(?:\d{{3}} |error:? )?(?:{_REASONS})[.!]?$")
_ERROR = re.compile(rf"(?i){_joined(ERRORS)}|^{_REASON.pattern[4:]}|^(?:oops!? )(?:{_REASONS})")
_LONGEST_REASON = 8 + max(len(s.phrase) for s in HTTPStatus)
_NOTICE = re.compile(f"(?i){_joined(NOTICES)}")
_FILLER = re.compile(f"(?i){_joined(FILLERS)}")
_DEFAULT = re.compile(f"(?i){DEFAULTS}")
_JSON_ERROR = re.compile(r'^\{.*"(?:error|status)"\s*:\s*(?:"[^"]*"|[45]\d\d).*\}$', re.S)
_PRINTF = re.compile(r"%[sd]\b")
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_QUOTED = ("\"'“‘«「『`", "\"'”’»」』`")
_WORD = re.compile(r"[^\W\d_]+")
_END = re.compile(r"[.!?。！？…]['\"”’»）)]?$")
_SENTENCE = re.compile(r"[^.!?。！？]+[.!?。！？]*['\"”’»）)]*\s*")
_BLANKS = re.compile(r"[\s,.;]+")


def placeholders(line: str) -> list[tuple[str, str, str, bool]]:
    """(placeholder, word before, word after, quoted) of each variable left in a line."""
    return [x[:4] for x in _variables(line)]


def _variables(line: str) -> list[tuple[str, str, str, bool, bool]]:
    """`placeholders` and whether each stands inside a sentence: three words or more on both sides and a sentence's end."""
    out = []
    ends = bool(_END.search(line))
    for m in _PLACEHOLDER.finditer(line):
        a, b = line[: m.start()].rstrip(), line[m.end() :].lstrip()
        quoted = a[-1:] != "" and a[-1:] in _QUOTED[0] and b[:1] != "" and b[:1] in _QUOTED[1]
        before, after = _WORD.findall(a[-60:]), _WORD.findall(b[:60])
        inside = ends and len(before) >= 3 and len(after) >= 3
        out.append((m.group(), before[-1].lower() if before else "", after[0].lower() if after else "", quoted, inside))
    if len(_PRINTF.findall(line)) >= 2:
        out.append(("%s", "", "", False, False))
    return out


def _literals() -> list[str]:
    """For every alternative of the message and filler patterns, the longest text it cannot match without."""
    out = []
    for block in (ERRORS, NOTICES, FILLERS):
        depth, each = 0, [""]
        for ch in block.strip().replace("\n", "|"):
            depth += (ch == "(") - (ch == ")")
            if ch == "|" and depth == 0:
                each.append("")
            else:
                each[-1] += ch
        for x in each:
            fixed = re.sub(r"\(.*?\)\??|\[.*?\][*+?]?|\\[A-Za-z][*+?]?|.\?|[\^$]", "\0", x)
            out.append(max(fixed.split("\0"), key=len).strip().lower())
    return [x for x in dict.fromkeys([*out, "oops", '"error"', '"status"']) if x]


_LITERALS = _literals()


@lru_cache(1)
def _finder():
    """Finds any of the literals in a lower-cased text, in one pass."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for w in _LITERALS:
        found.add_word(w, 1)
    found.make_automaton()
    return found


def _worded(text: str) -> bool:
    return next(_finder().iter(text.lower()), None) is not None


def _is_reason(line: str) -> bool:
    """Whether a line is a server's reason phrase and no more; a longer one cannot be."""
    return len(line) <= _LONGEST_REASON and _REASON.match(line) is not None


def repeated(text: str) -> bool:
    """Whether a text is one word or phrase three times or more, whatever blanks and stops part them."""
    t = _BLANKS.sub("", text.lower())
    at = (t + t).find(t, 1) if len(t) >= 6 else 0
    return 1 <= at <= len(t) // 3 and t[0].isalnum()


def told(line: str) -> tuple[str, int]:
    """What a line says and how many of its characters say it.

    'error' or 'notice' if a sentence of it does, 'filler', 'default' for a value never filled, else ''. A
    line counts whole if half of it are such sentences. A phrase of filler must be a sixth of its
    sentence, else the sentence is about something. Lines of any length are read alike.
    """
    parts = [" ".join(x.split()) for x in _TAG.split(line)]
    bare = " ".join(x for x in parts if x)
    if not bare:
        return "", 0
    if all(_DEFAULT.match(w.strip(".,;")) for w in bare.split()):
        return "default", len(line)
    if _OPENS.match(bare) or repeated(bare):
        return "filler", len(line)
    if _JSON_ERROR.match(bare):
        return "error", len(line)
    kind, amount = "", 0
    if _worded(bare) or any(map(_is_reason, parts)):
        sentences = [x for p in parts for x in _SENTENCE.findall(p)]
        for x in sentences:
            m = _FILLER.search(x)
            if m and 6 * len(m.group()) >= len(x.strip()):
                return "filler", len(line)
        for each in (sentences, parts):  # a message may also run over a stop
            if kind:
                break
            for x in each:
                one = "notice" if _NOTICE.search(x) else "error" if _ERROR.search(x.strip()) else ""
                if one:
                    kind, amount = kind or one, amount + len(x)
    if kind and len(parts) > 1:  # the codes and references in the markup of a message
        amount += sum(len(p) for p in parts if len(p) <= _HINT and not _NOTICE.search(p) and not _ERROR.search(p))
    return kind, len(line) if 2 * amount >= len(bare) else amount


def says(line: str) -> str:
    """What a line says, see `told`."""
    return told(line)[0]


def _mask(line: str) -> str:
    return re.sub(r"\b(?=[0-9a-f]*\d)[0-9a-f]{3,}\b|\d+", "0", line.lower())


def _print(text: str) -> str:
    return blake2b(_mask(text).encode("utf-8", "replace"), digest_size=16).hexdigest()


#: Lines up to this length may be buttons and hints beside a message.
_HINT = 60
_OPENS = re.compile(r"\W*(?:(?i:lorem ipsum)|TODO\b)")
_SIGNS = ("{", "<", "[", "%", "&&", "__")


def _made_of(line: str, vocabulary: frozenset, share: float = 0.9) -> bool:
    """Whether a line of four words or more takes `share` of them from the vocabulary."""
    # of n words at most (1 - share) n stand outside, so one of the first (1 - share) n + 1 stands inside; n <= half the length
    if not vocabulary or not any(w.strip(".,;:").lower() in vocabulary for w in line.split(None, int((1 - share) * len(line) / 2) + 2)[: int((1 - share) * len(line) / 2) + 2]):
        return False
    words = [w.lower() for w in _WORD.findall(line)]
    return len(words) >= 4 and sum(w in vocabulary for w in words) >= share * len(words)


def suspects(vocabulary: frozenset):
    """Which lines of a page matter: every line is read; of a page with the wording of a message, all are kept.

    Lines of the furniture that are residue themselves are read too: a slot or message that recurs on many pages is pruned like a menu.
    """

    def keep(x: str) -> bool:
        return any(c in x for c in _SIGNS) or bool(_OPENS.match(x)) or _DEFAULT_WORD.match(x) is not None or repeated(x) or _made_of(x, vocabulary)

    def pick(lines: list[str], size: int, furniture: list[str]) -> tuple[list[str], int, str | None]:
        back = [x for x in furniture if _telling(x)]
        page = _print(" / ".join(lines)) if lines else None
        size += sum(map(len, back))
        if back or lines and _worded("\n".join(lines)) or any(map(_is_reason, lines)):
            return lines + back, size, page
        return [x for x in lines if keep(x)], size, page

    return pick


_DEFAULT_WORD = re.compile(r"\W*(?:undefined|null|none|nan|n/a|tbd|xxx|test)\b", re.I)


@lru_cache(50_000)
def _telling(line: str) -> bool:
    """A furniture line that holds an open slot, a message, filler or a default; 'Test' and 'None' may name a section there."""
    if line.strip(" .,;").lower() in ("test", "none"):
        return False
    return any(not p[3] for p in placeholders(line)) or says(line) != ""


def _scan(vocabulary: frozenset, share: float = 0.6, hint: int = _HINT):
    """Per page what it holds, as rows (id, kind, a, b, c, quoted, inside, line); kinds: slot, says.

    A page is an error page if `share` of what it keeps are messages and the short lines (buttons, hints) beside them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for id_, size, rest in zip(*(batch.column(i).to_pylist() for i in range(3))):
                amount, kinds = 0, set()
                for x in rest:
                    if any(c in x for c in _SIGNS):
                        for p, before, after, quoted, inside in _variables(x):
                            rows.append((id_, "slot", p, before, after, quoted, inside, _print(x)))
                    kind, n = told(x)
                    if not kind and _made_of(x, vocabulary):
                        kind = "filler"
                    kinds.add(kind)
                    amount += len(x) if len(x) <= hint else n
                if kinds & {"filler", "default"}:
                    rows.append((id_, "says", "filler", "", "", False, False, ""))
                if kinds & {"error", "notice"} and amount >= share * size:
                    rows.append((id_, "says", "error", "", "", False, False, ""))
            cols = list(zip(*rows)) if rows else [()] * 8
            types = [pa.int64(), *[pa.string()] * 4, pa.bool_(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["id", "kind", "a", "b", "c", "quoted", "inside", "line"])

    return run


_SCHEMA = "id bigint, kind string, a string, b string, c string, quoted boolean, inside boolean, line string"


def _title_sketch(title):
    """Three min-hashes of the title's words: near copies of a title share them."""
    words = F.filter(F.split(F.lower(F.coalesce(title, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return [F.array_min(F.transform(words, lambda w, s=s: F.xxhash64(F.lit(s), w))) for s in (1, 2, 3)]


def _notes(items: DataFrame, id_col: str, note_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [bool([p for p in placeholders(x) if not p[3]]) or says(x) != "" for x in batch.column(1).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    # the remarks readers leave are few: each distinct one is read once
    values = items.select(F.col(note_col).alias("note")).filter("note <> ''").distinct()
    bad = values.select(F.lit(0).cast("bigint").alias("i"), "note").mapInArrow(run, "i bigint, note string").select("note")
    return items.select(F.col(id_col).alias("id"), F.col(note_col).alias("note")).join(bad, "note", "left_semi").select("id")


def filler_vocabulary(items: DataFrame, body_col: str = "body_text", rarest: int = 200) -> frozenset:
    """The words of the lines that open with 'lorem ipsum', those that stand in one of `rarest` such lines or more, twice at least.

    They are at most `rarest` times as many as the words of a usual line, however large the collection.
    """
    pages = items.select(F.col(body_col).alias("body")).filter(F.lower("body").contains("lorem ipsum"))
    lines = pages.select(F.explode(F.split("body", "\n")).alias("x")).filter(F.col("x").rlike(r"(?i)^\W*lorem ipsum"))
    words = F.array_distinct(F.filter(F.split(F.lower("x"), r"[^\p{L}]+"), lambda w: F.length(w) > 2))
    each = lines.select(F.explode(F.array_append(words, F.lit(""))).alias("w"))  # '' counts the lines themselves
    n = each.groupBy("w").agg(F.count("*").alias("n"))
    most = n.filter("w = ''").select(F.col("n").alias("lines"))
    known = n.filter("n >= 2 and w <> ''").join(F.broadcast(most), F.col("n") * rarest >= F.col("lines"))  # `most` is one row
    return frozenset(r["w"] for r in known.select("w").collect())


def parted_suspects(items: DataFrame, id_col: str = "ingest_seq", host_col: str = "source_id", body_col: str = "body_text") -> tuple[DataFrame, frozenset]:
    """The pages without their furniture, written once: `boilerplate.parted_pages` with the lines worth keeping; and the filler vocabulary."""
    vocabulary = filler_vocabulary(items, body_col)
    return pin_table(boilerplate.parted_pages(items, id_col, host_col, body_col, wanted=suspects(vocabulary))), vocabulary


def residue(items: DataFrame, id_col: str = "ingest_seq", host_col: str = "source_id", title_col: str = "title", body_col: str = "body_text", note_col: str = "fulltext_note", least: int = 3, parted: tuple[DataFrame, frozenset] | None = None) -> DataFrame:
    """(id, field_name) of the values that hold residue in the place of content; field_name is the column.

    Method. What a page keeps after its furniture is pruned, and furniture that is residue itself, is aligned with the other pages. A variable
    left in it is a slot nobody filled, unless it is quoted or stands inside a sentence between the same
    words beside `least` or more stories: then it is part of a sentence about templates, if not the whole
    sentence recurs too. Lines of filler or of values that were never filled count wherever they stand.
    Pages are aligned whole, with numbers and references masked: a page that stands under `least` or more
    unlike titles is a repeated error template, unless its titles' words mostly stand in it, as those of
    an article printed under several headlines do. A page that mostly consists of server messages or
    browser notices is an error page too. The filler vocabulary is learned from the lines that open with
    its usual words. All lines of all pages are read, whatever their length.

    Null and empty values are no residue; articles that write about such things are none; repeated rows
    are all given; other columns are ignored; an empty table gives no rows.
    """
    parted, vocabulary = parted or parted_suspects(items, id_col, host_col, body_col)
    rest = parted.filter("size(rest) > 0").select("id", "size", "rest")
    found = pin_table(rest.mapInArrow(_scan(vocabulary), _SCHEMA))
    stories = items.select(F.col(id_col).cast("bigint").alias("id"), *[c.alias(f"t{i}") for i, c in enumerate(_title_sketch(F.col(title_col)))])
    distinct = [F.count_distinct(f"t{i}").alias(f"n{i}") for i in range(3)]
    slots = found.filter("kind = 'slot'").join(stories, "id")
    fixed = slots.groupBy("a", "b", "c").agg(*distinct).filter((F.least("n0", "n1", "n2") >= least) & ((F.col("b") != "") | (F.col("c") != ""))).select("a", "b", "c")
    copied = slots.filter("inside").groupBy("line").agg(*distinct).filter(F.least("n0", "n1", "n2") >= least).select("line")
    about = slots.filter("inside").join(fixed, ["a", "b", "c"], "left_semi").join(copied, "line", "left_anti").select("id", "a", "b", "c", "line")
    unfilled = slots.filter("not quoted").join(about, ["id", "a", "b", "c", "line"], "left_anti").select("id")
    pages = parted.filter("page is not null").select("id", "page")
    often = pages.groupBy("page").count().filter(F.col("count") >= least).select("page")
    pages = pin_table(pages.join(often, "page", "left_semi").join(stories, "id"))
    unlike = pages.groupBy("page").agg(*distinct).filter(F.least("n0", "n1", "n2") >= least).select("page")
    templates = _unlike_titles(pages.join(unlike, "page", "left_semi"), items, id_col, title_col, body_col)
    said = found.filter("kind = 'says'").select("id")
    body = unfilled.union(templates).union(said).distinct()
    notes = _notes(items, id_col, note_col).distinct()
    return body.select(F.col("id").alias(id_col), F.lit(body_col).alias("field_name")).union(notes.select(F.col("id").alias(id_col), F.lit(note_col)))


def _unlike_titles(pages: DataFrame, items: DataFrame, id_col: str, title_col: str, body_col: str) -> DataFrame:
    """(id) of the pages(id, page) whose titles' words mostly do not stand in the page."""
    words = F.array_distinct(F.filter(F.split(F.lower(title_col), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    inside = F.size(F.filter(words, lambda w: F.contains(F.lower(body_col), w)))
    share = items.select(F.col(id_col).cast("bigint").alias("id"), F.when(F.size(words) > 0, inside / F.size(words)).alias("share"))
    told = pages.select("id", "page").join(share, "id")
    unlike = told.groupBy("page").agg(F.avg("share").alias("share")).filter("coalesce(share, 0) < 0.5").select("page")
    return pages.join(unlike, "page", "left_semi").select("id")
