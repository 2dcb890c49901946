"""Main text of pages: site style trees over the pages of each host, pruned by the entropy of their nodes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.runtime import pin_table

# How a call to act, an advert label, a consent notice or a rights line is worded.
WIDGET_WORDS = """
advertis sponsored promoted anzeige werbung publicidad publicité annonce реклама 广告 赞助
share teilen compartir partager поделиться 分享 print drucken
newsletter boletín infolettre lettre рассылк 快讯 subscribe abonnier abonnez suscri подпи 订阅 sign up
follow us folgen síguenos suivez подписывайтесь 关注我们 our channels
get the app download app herunterladen descarga téléchargez скачайте 扫码 客户端
comments kommentare comentarios commentaires комментари 评论 join the conversation
listen to anhören escuch écout слуша 收听
""".split("\n")
CONSENT = ("cookie", "consent at any time", "similar identifiers", "storage technologies", "small files on your device", "ähnliche technologien", "traceurs", "rastreadores", "隐私说明", "同类技术")
RIGHTS = ("all rights reserved", "rechte vorbehalten", "derechos reservados", "droits réservés", "права защищены", "未经授权", "without consent is not allowed")
RIGHTS_OPEN = ("©", "(c) 1", "(c) 2", "copyright", "版权所有")

_SENTENCE = re.compile(r"[.!?。！？…]['\"”’»）)]?$")
_CLAUSES = re.compile(r"[^.!?。！？]+[.!?。！？]*\s*")
_DASHED = re.compile(r"^[-*•–—▪●]\s*\S")
_MARKS = ("|", "·", "•", "›", "»", "/", "≡", "  ")
_SPLIT = re.compile(r"\s*[|·•›»/≡]\s*|\s{2,}")


def _widget_pattern() -> re.Pattern:
    phrases = ["sign up", "follow us", "our channels", "get the app", "download app", "join the conversation", "listen to"]
    words = [w for line in WIDGET_WORDS for w in line.split() if w not in {x for p in phrases for x in p.split()}]
    return re.compile("(?i)" + "|".join(map(re.escape, [*phrases, *words])))


_NO_HEADING = re.compile(_widget_pattern().pattern + r"|[0-9|·›»/:：≡(]")


@dataclass(frozen=True)
class StyleTree:
    """A node is one line of text, digits masked, under its host and, across hosts, under all.

    Its importance is 2^-H, H the entropy (bits) over the stories it stands beside, each counted once: a
    line of one story keeps 1 and a line beside eight stories has 1/8, however often the stories are copied. `host` and `all_hosts` are the importances from which on a label counts as low; sentences, which
    near copies of a story may share, must be rarer still (`sentence`). Furniture stands beside articles: a
    node counts only if `beside_article` of its occurrences are on pages with sentences of `article_chars`
    together, which a server's message that fills whole pages never is. `blocks_over` nodes are held by
    the executors at most; more are joined line by line.
    """

    host: float = 1 / 3.5
    all_hosts: float = 1 / 7.5
    sentence: float = 1 / 11.5
    article_chars: int = 300
    beside_article: float = 0.1
    blocks_over: int = 2_000_000


def _lines(body: Column) -> Column:
    return F.transform(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c\u0085\u00a0\u2003\u2009\u200b\u202f\u3000\ufeff")))


def _keys(lines: Column) -> Column:
    """Per line the identity of its node; null for blank lines."""
    return F.transform(lines, lambda x: F.when(x != "", F.xxhash64(F.regexp_replace(x, r"[0-9]+", "0"))))


def _sentence_like(x: Column) -> Column:
    return x.rlike(r"[.!?。！？…]['\"”’»）)]?$") & ((F.length(x) > 45) | (x.rlike(r"[一-鿿]") & (F.length(x) > 16)))


def low_nodes(pages: DataFrame, tree: StyleTree) -> DataFrame:
    """(key, host, heads) of the unimportant nodes of pages(host, lines, keys); host is null where they are so on all hosts.

    `heads` tells that the node mostly follows a sentence, as subheadings do and entries of menus do not.

    A page's story is its longest line. Occurrences are counted per (node, story) first, so a line on a
    third of all pages spreads over as many keys as stories and then meets as partial sums.
    """
    story = F.array_max(F.transform("lines", lambda x: F.struct(F.length(x).alias("n"), F.xxhash64(x).alias("h"))))["h"]
    both = F.filter(F.arrays_zip("keys", F.transform("lines", _sentence_like).alias("s")), lambda x: x["keys"].isNotNull())
    amount = F.aggregate(F.filter("lines", _sentence_like), F.lit(0), lambda n, x: n + F.length(x))
    rich = (amount >= tree.article_chars).cast("int")
    each = pages.select("host", story.alias("story"), rich.alias("r"), F.explode(F.array(both)).alias("both")).select("host", "story", "r", F.explode(F.transform("both", lambda x, i: F.struct(x["keys"].alias("key"), x["s"].alias("s"), F.coalesce(F.get(F.col("both"), i - 1)["s"], F.lit(False)).cast("int").alias("p")))).alias("l"))
    count = each.select("host", "story", "r", "l.*").filter("key is not null").repartition("key", "story").groupBy("key", "story", "host").agg(F.count("*").alias("n"), F.max("s").alias("s"), F.sum("p").alias("p"), F.sum("r").alias("r"))  # one shuffle serves both uses
    h = F.log2(F.count("*"))  # of equal shares, one per story
    whole = (
        count.groupBy("key", "story").agg(F.sum("n").alias("n"), F.sum("p").alias("p"), F.sum("r").alias("r"), F.max("s").alias("s"), F.min("host").alias("lo"), F.max("host").alias("hi"))
        .groupBy("key").agg(F.count("*").alias("stories"), h.alias("h"), F.max("s").alias("s"), (F.sum("p") * 2 >= F.sum("n")).alias("heads"), (F.sum("r") >= tree.beside_article * F.sum("n")).alias("beside"), (F.min("lo") < F.max("hi")).alias("several"))
    )
    seen = pin_table(whole.filter((F.col("stories") >= 2) & F.col("beside")).withColumn("importance", F.pow(F.lit(2.0), -F.col("h"))).filter(F.col("importance") <= tree.host).select("key", "importance", "several", "s", "heads"))
    everywhere = seen.filter(F.col("several") & (F.col("importance") <= F.when(F.col("s"), tree.sentence).otherwise(tree.all_hosts)))
    own = count.join(seen.select("key"), "key").groupBy("key", "host").agg(h.alias("h"), F.max("s").alias("s"), (F.sum("p") * 2 >= F.sum("n")).alias("heads"))
    own = own.filter(F.pow(F.lit(2.0), -F.col("h")) <= F.when(F.col("s"), tree.sentence).otherwise(tree.host))
    return everywhere.select("key", F.lit(None).cast("string").alias("host"), "heads").union(own.select("key", "host", "heads"))


def _is_links(line: str) -> bool:
    if not any(c in line for c in _MARKS):
        return False
    parts = [p for p in _SPLIT.split(line) if p]
    return len(parts) >= 3 and max(map(len, parts)) <= 24 and not _SENTENCE.search(line) and not _DASHED.match(line)


def _is_rights(line: str) -> bool:
    low = line.lower()
    return low.startswith(RIGHTS_OPEN) or any(k in low for k in RIGHTS)


def _is_consent(line: str) -> bool:
    """Half of the line or more are sentences about stored identifiers, without quotations and figures."""
    low = line.lower()
    if not any(k in low for k in CONSENT) or any(c in line for c in "\"“0123456789"):
        return False
    return 2 * sum(len(x) for x in _CLAUSES.findall(low) if any(k in x for k in CONSENT)) >= len(low)


def page_lines(lines: list[str], low: list[bool], heads: list[bool]) -> list[int]:
    """Numbers (from 1) of the lines that belong to the page around the article.

    Low nodes go, and rows of links, rights and consent lines by their style. Two branches go with their
    head: the buttons under a consent line, and the teasers that follow a low label at once and end no
    sentence. A low label that elsewhere follows the article's sentences (`heads`), calls to no act and
    has text of the article after it is a subheading and stays.
    """
    out = set()
    text = [x.strip() for x in lines]
    sentence = [bool(_SENTENCE.search(x)) for x in text]
    n = len(text)
    full = [i for i in range(n) if text[i]]
    consent = {i for i in full if _is_consent(text[i])}
    buttons = set()
    for i in sorted(consent):
        j = i + 1
        while j < n and text[j] and len(text[j]) <= 40 and not _DASHED.match(text[j]) and (low[j] or not sentence[j]):
            buttons.add(j)
            j += 1
    bad = {i for i in full if i in consent or i in buttons or low[i] or _is_links(text[i]) or _is_rights(text[i])}
    for i in full:
        if i not in bad or i in out:
            continue
        label = low[i] and i not in consent and not sentence[i] and len(text[i]) <= 40 and not _is_links(text[i])
        j = i + 1
        if label and j < n and text[j] and j not in bad and not sentence[j] and not _DASHED.match(text[j]):
            out.add(i)
            while j < n and text[j] and j not in bad and not sentence[j]:
                out.add(j)
                j += 1
        elif not (label and i not in buttons and heads[i] and not _NO_HEADING.search(text[i])):
            out.add(i)
    return sorted(i + 1 for i in out)


def _flags(model, host, lines, keys) -> tuple[list[bool], list[bool]]:
    if model.of_host is None:
        marked = {m["at"]: m["heads"] for m in keys or ()}
        return [i in marked for i in range(len(lines))], [marked.get(i, False) for i in range(len(lines))]
    own = model.of_host.get(host, {})
    return [k in own or k in model.everywhere for k in keys], [own.get(k, model.everywhere.get(k, False)) for k in keys]


def _classify(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers = [], []
            for id_, host, lines, keys in zip(*(batch.column(i).to_pylist() for i in range(4))):
                found = page_lines(lines, *_flags(model, host, lines, keys))
                ids += [id_] * len(found)
                numbers += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32())], names=["id", "line_no"])

    return run


def _parted(model, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, gone, rest, size, page = [], [], [], [], []
            for id_, host, lines, keys in zip(*(batch.column(i).to_pylist() for i in range(4))):
                found = page_lines(lines, *_flags(model, host, lines, keys))
                out = set(found)
                kept = [x for i, x in enumerate(lines, 1) if x and i not in out]
                ids.append(id_)
                gone.append(found)
                size.append(sum(map(len, kept)))
                if wanted is not None:
                    kept, size[-1], print_ = wanted(kept, size[-1], [lines[i - 1] for i in found])
                    page.append(print_)
                else:
                    page.append(None)
                rest.append(kept)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(gone, pa.list_(pa.int32())), pa.array(size, pa.int64()), pa.array(rest, pa.list_(pa.string())), pa.array(page, pa.string())], names=["id", "gone", "size", "rest", "page"]
            )

    return run


def _pages(df: DataFrame, id_col: str, host_col: str, body_col: str) -> DataFrame:
    own = df.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.col(body_col).alias("body")).filter("body <> ''")
    # two generated columns: later projections would else repeat the pattern work for every use
    return own.withColumn("lines", F.explode(F.array(_lines(F.col("body"))))).drop("body").withColumn("keys", F.explode(F.array(_keys(F.col("lines")))))


@dataclass(frozen=True)
class Model:
    """The low nodes of every host's tree: held here up to `blocks_over`, else as a table to join (of_host is None)."""

    everywhere: dict
    of_host: dict | None
    nodes: DataFrame | None = None

    def __reduce__(self):  # the table stays on the driver
        return (Model, (self.everywhere, self.of_host))


def fit(df: DataFrame, id_col: str = "ingest_seq", host_col: str = "source_id", body_col: str = "body_text", tree: StyleTree = StyleTree()) -> Model:
    """Merge the pages of every host and keep the nodes whose importance is low."""
    nodes = pin_table(low_nodes(_pages(df, id_col, host_col, body_col), tree))
    if nodes.count() > tree.blocks_over:
        return Model({}, None, nodes)
    of_host: dict = {}
    for r in nodes.select("host", "key", "heads").toLocalIterator():  # at most blocks_over rows
        of_host.setdefault(r["host"], {})[r["key"]] = r["heads"]
    return Model(of_host.pop(None, {}), of_host)


def _marked(pages: DataFrame, model: Model) -> DataFrame:
    if model.of_host is not None:
        return pages.select("id", "host", "lines", "keys")
    each = pages.select("id", "host", F.posexplode("keys").alias("at", "key")).filter("key is not null")
    nodes = model.nodes
    wide = each.join(nodes.filter("host is null").select("key", "heads"), "key").select("id", "at", "heads", F.lit(0).alias("o"))
    low = wide.union(each.join(nodes.filter("host is not null"), ["key", "host"]).select("id", "at", "heads", F.lit(1)))
    low = low.groupBy("id", "at").agg(F.max_by("heads", "o").alias("heads"))
    marked = low.groupBy("id").agg(F.collect_list(F.struct("at", "heads")).alias("keys"))  # lines of one page
    return pages.select("id", "host", "lines").join(marked, "id", "left").select("id", "host", "lines", "keys")


def furniture_lines(df: DataFrame, id_col: str = "ingest_seq", host_col: str = "source_id", body_col: str = "body_text", tree: StyleTree = StyleTree(), model: Model | None = None) -> DataFrame:
    """(id, line_no) of every non-blank line that belongs to the page around the article.

    Method: site style trees. The pages of a host are merged line by line into nodes, which gain or lose
    importance by the entropy of the stories they stand beside; low nodes are removed from each page with
    their branches. Null and empty bodies give no rows; a page of one long line keeps it; repeated pages
    count as one story; a null host is a host of its own; other columns are ignored. A repeated id gives
    the lines of each of its rows.
    """
    model = model or fit(df, id_col, host_col, body_col, tree)
    found = _marked(_pages(df, id_col, host_col, body_col), model).mapInArrow(_classify(model), "id bigint, line_no int")
    return found.select(F.col("id").alias(id_col), "line_no")


def parted_pages(df: DataFrame, id_col: str = "ingest_seq", host_col: str = "source_id", body_col: str = "body_text", tree: StyleTree = StyleTree(), model: Model | None = None, wanted=None) -> DataFrame:
    """(id, gone, size, rest, page): the numbers of each page's furniture lines, how many characters the others hold and those others.

    `wanted(lines, size, furniture)` may pick which lines are carried along, correct `size`, which counts
    all the others, and give a fingerprint of the whole `page`, null without it.
    """
    model = model or fit(df, id_col, host_col, body_col, tree)
    return _marked(_pages(df, id_col, host_col, body_col), model).mapInArrow(_parted(model, wanted), "id bigint, gone array<int>, size bigint, rest array<string>, page string")


def main_text(df: DataFrame, id_col: str = "ingest_seq", host_col: str = "source_id", body_col: str = "body_text", tree: StyleTree = StyleTree()) -> DataFrame:
    """(id, main_text): each page's own lines, joined by line breaks; '' where nothing is left. Null and empty bodies give no row."""
    return parted_pages(df, id_col, host_col, body_col, tree).select(F.col("id").alias(id_col), F.concat_ws("\n", "rest").alias("main_text"))
