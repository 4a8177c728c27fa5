"""Main text of web pages by deducing the template of their host.

A token is a tag with the containers around it. Tokens of a host that occur equally often on each
of its pages have one occurrence vector and form an equivalence class; the vectors are compared by a
sum of hashes of (page, number of occurrences), which any number of tasks may add up. A class is
valid if it stands on most of the host's pages. The class of tokens that stand once on each page is the
template's frame; the others nest into it by their containers. What is left between template tokens
are slots, each named by the innermost container in a valid class. A slot is main text if nothing
around it is a menu, a footer or the like, its text outside an article is mostly no links, and it is inside the frame's
article where the frame has one. Where it has none, slots of the same text on every page are left out,
unless no others have text.

Tokens and texts are counted over the distinct pages of a host, so copies of a page change nothing.
Per host only tokens of most of its pages are gathered, so a template is no longer than a page, and a
host may have any number of pages. Pages without a host share one. Null and empty pages have an
empty text; tags that are not closed end with what is around them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.shipping import ship
from marketlake.llm.stored import stored

MOST = 0.5
LINKS = 0.5
SAME = 0.1
#: Templates of at most so many hosts are broadcast; beyond, hosts are split into `SALTS` parts and joined.
BROADCAST_ROWS = 20_000
#: Hashes of repeated pages are broadcast up to so many; beyond, all pages are shuffled to find the distinct ones.
REPEATED_ROWS = 500_000
SALTS = 64

_PIECE = re.compile(
    r"<!--.*?(?:-->|$)|<(script|style|noscript|template|textarea|svg|iframe)\b[^>]*>.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>",
    re.S | re.I,
)
#: A comment or an element without text that nothing closes: it reaches to the end of the page.
_OPEN = re.compile(r"<!--(?!.*-->\Z)|<(script|style|noscript|template|textarea|svg|iframe)\b(?!.*</\1\s*>\Z)", re.S | re.I)
_CLASS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

CONTAINERS = set(
    "html head body main article section div nav header footer aside form ul ol dl table figure "
    "details dialog fieldset select button title".split()
)
BLOCKS = CONTAINERS | set("p h1 h2 h3 h4 h5 h6 li dt dd tr td th pre blockquote hr figcaption caption option legend address".split())
#: Containers, and words in their class, id or role, that hold no main text.
NO_TEXT_TAGS = set("head nav header footer aside form select button title dialog".split())
NO_TEXT_WORDS = set(
    "ad ads advert advertisement adverts sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar widget related share social cookie cookies consent notice alert popup modal newsletter subscribe signup login "
    "search footer header masthead copyright comment comments respond replies disqus pagination pager toolbar skip".split()
)
#: Containers of the whole page or of the article: their classes tell of what is around the text. A header in an article is its heading.
WHOLE_TAGS = set("html body article main".split())
_WORD = re.compile(r"[a-z]+")


def _named(tag: str, attributes: str) -> str:
    names = {w for m in _CLASS.finditer(attributes) for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower())}
    return ".".join([tag, *sorted(names)])


def excluded(path: str) -> bool:
    """Whether a container around a slot holds no main text."""
    article = False
    for element in path.split("/"):
        tag, *words = element.split(".")
        if tag in WHOLE_TAGS:
            article = article or tag == "article"
        elif tag == "header" and article:
            continue
        elif tag in NO_TEXT_TAGS or not NO_TEXT_WORDS.isdisjoint(words):
            return True
    return False


def walk(page: str | None) -> Iterator[tuple[str, str, str, bool]]:
    """(kind, path, value, in a link): kind is `tag`, with its name, `text`, or `break` between blocks."""
    stack: list[str] = []
    path, links, at = "", 0, 0
    page = page or ""
    # behind the last > there is no tag, however many are opened
    last = page.rfind(">") + 1
    for m in _PIECE.finditer(page, 0, last):
        if m.start() > at:
            yield "text", path, page[at : m.start()], links > 0
        at = m.end()
        tag = m[3]
        if at == last and tag is None and _OPEN.match(m[0]):
            at = len(page)
        if tag is None:
            continue
        tag = tag.lower()
        closing = m[2] == "/"
        if tag in BLOCKS:
            yield "break", path, "", False
            links = 0
        elif tag == "br":
            yield "text", path, " ", links > 0
        if tag == "a":
            links = 0 if closing else 1
        if closing:
            if tag in CONTAINERS:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].split(".", 1)[0] == tag:
                        del stack[i:]
                        path = "/".join(stack)
                        break
            continue
        name = _named(tag, m[4]) if tag in CONTAINERS else tag
        yield "tag", path, name, False
        if tag in CONTAINERS and not m[4].endswith("/"):
            stack.append(name)
            path = "/".join(stack)
    rest = page[at:].partition("<!--")[0]
    if rest:
        yield "text", path, rest, links > 0


def page_tokens(page: str | None) -> dict[str, list]:
    """By path: occurrences, characters of text, those in links, and a digest of the text directly inside."""
    found: dict[str, list] = {}
    for kind, path, value, linked in walk(page):
        if kind == "tag":
            token = f"{path}/{value}" if path else value
            found.setdefault(token, [0, 0, 0, 0])[0] += 1
        elif kind == "text" and not value.isspace():
            n = len(value.strip())
            entry = found.setdefault(path, [0, 0, 0, 0])
            entry[1] += n
            entry[2] += n if linked else 0
            entry[3] = hash_text(value, entry[3])
    return found


def hash_text(value: str, seed: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(value.encode("utf-8"), seed & 0x7FFFFFFF) >> 1


def main_text(page: str | None, template: set[str], main: set[str]) -> str:
    """The blocks of the slots in `main`; a slot is the innermost container in `template`."""
    blocks: list[str] = []
    open_block: list[str] = []
    keep: dict[str, bool] = {}

    def close() -> None:
        words = html.unescape("".join(open_block)).split()
        if words:
            blocks.append(" ".join(words))
        open_block.clear()

    for kind, path, value, _ in walk(page):
        if kind == "break":
            close()
        elif kind == "text":
            kept = keep.get(path)
            if kept is None:
                slot = path
                while slot and slot not in template:
                    slot = slot.rpartition("/")[0]
                kept = keep[path] = slot in main and not excluded(path)
            if kept:
                open_block.append(value)
    close()
    return "\n\n".join(blocks)


def _hosted(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"), F.xxhash64("page_id", "url", "html").alias("__page")
    )


def _distinct(hosted: DataFrame) -> DataFrame:
    """(host, page, html): one row of each distinct page of a host; only pages with copies are shuffled."""
    hashed = hosted.select("host", F.xxhash64("host", "html").alias("page"), "html")
    repeated = hashed.groupBy("page").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    repeated = stored(repeated.select(F.col("page").alias("__repeated")), "template_repeated")
    if repeated.count() > REPEATED_ROWS:
        return hashed.dropDuplicates(["page"])
    marked = hashed.join(F.broadcast(repeated), F.col("page") == F.col("__repeated"), "left")
    copies = marked.where(F.col("__repeated").isNotNull()).dropDuplicates(["page"])
    return marked.where(F.col("__repeated").isNull()).unionByName(copies).drop("__repeated")


def templates(pages: DataFrame) -> DataFrame:
    """(host, tokens, main): the containers in each host's template, and those whose slots are main text."""
    ship(pages.sparkSession)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("host", pa.string()), ("page", pa.int64()), ("token", pa.string()), ("n", pa.int64()), ("chars", pa.int64()), ("linked", pa.int64()), ("digest", pa.int64())])
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows = [
                    (host, page, token, *values)
                    for host, page, text in zip(part.column("host").to_pylist(), part.column("page").to_pylist(), part.column("html").to_pylist())
                    for token, values in page_tokens(text).items()
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(zip(*rows), schema)] if rows else [pa.array([], type=t.type) for t in schema], schema=schema)

    hosted = _hosted(pages)
    seen = _distinct(hosted).mapInArrow(
        tokens, "host string, page long, token string, n long, chars long, linked long, digest long"
    )
    each = hosted.select("host", F.xxhash64("host", "html").alias("page")).distinct()
    sizes = stored(each.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")), "template_hosts")
    if sizes.count() <= BROADCAST_ROWS:
        sizes = F.broadcast(sizes)
    # the sum of hashes stands for the occurrence vector; decimals keep it from overflowing
    vector = F.sum(F.when(F.col("n") > 0, F.xxhash64("page", "n").cast("decimal(20,0)")))
    counted = seen.groupBy("host", "token").agg(
        F.count(F.when(F.col("n") > 0, 1)).alias("pages"),
        F.max("n").alias("most"),
        vector.alias("vector"),
        F.sum("chars").alias("chars"),
        F.sum("linked").alias("linked"),
        F.approx_count_distinct(F.when(F.col("chars") > 0, F.col("digest"))).alias("texts"),
        F.count(F.when(F.col("chars") > 0, 1)).alias("filled"),
    )
    valid = stored(
        counted.join(sizes, "host")
        .where(F.col("pages") >= F.greatest(F.lit(1), F.ceil(F.col("host_pages") * MOST))),
        "template_tokens",
    )
    classes = valid.groupBy("host", "vector").agg(
        F.collect_list(F.struct("token", "chars", "linked", "texts", "filled")).alias("members"),
        F.max((F.col("most") == 1) & (F.col("pages") == F.col("host_pages"))).alias("frame"),
    )
    by_host = classes.groupBy("host").agg(F.collect_list(F.struct("frame", "members")).alias("classes"))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, all_tokens, mains = [], [], []
            for row in batch.to_pylist():
                nested = {m["token"]: (c["frame"], m) for c in row["classes"] for m in c["members"]}
                hosts.append(row["host"])
                all_tokens.append(sorted(t for t in nested if t.rpartition("/")[2].split(".", 1)[0] in CONTAINERS))
                mains.append(sorted(main_slots(nested)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, type=pa.string()), pa.array(all_tokens, type=pa.list_(pa.string())), pa.array(mains, type=pa.list_(pa.string()))],
                names=["host", "tokens", "main"],
            )

    return by_host.mapInArrow(chosen, "host string, tokens array<string>, main array<string>")


def main_slots(tokens: dict[str, tuple[bool, dict]]) -> set[str]:
    """The containers of a template whose slots are main text."""
    good = {}
    for token, (frame, stats) in tokens.items():
        if token.rpartition("/")[2].split(".", 1)[0] not in CONTAINERS or excluded(token):
            continue
        whole = any(e.split(".", 1)[0] in ("article", "main") for e in token.split("/"))
        if not whole and stats["chars"] and stats["linked"] >= LINKS * stats["chars"]:
            continue
        good[token] = (frame, stats)
    for tag in ("article", "main"):
        inside = {t for t in good if any(e.split(".", 1)[0] == tag for e in t.split("/"))}
        if any(good[t][0] for t in inside):
            return inside
    differing = {t for t, (_, stats) in good.items() if stats["filled"] < 10 or stats["texts"] > SAME * stats["filled"]}
    return differing if any(good[t][1]["chars"] for t in differing) else set(good)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    found = stored(templates(pages), "templates")
    hosted = _hosted(pages)
    if found.count() <= BROADCAST_ROWS:
        joined = hosted.join(F.broadcast(found), "host", "left")
    else:
        salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = hosted.withColumn("salt", F.pmod("__page", F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                made = [
                    main_text(page, set(tokens or ()), set(main or ()))
                    for page, tokens, main in zip(part.column("html").to_pylist(), part.column("tokens").to_pylist(), part.column("main").to_pylist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(made, type=pa.string()), pa.array([len(t) for t in made], type=pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return joined.select(F.col("page_id").cast("long"), "url", "html", "tokens", "main").mapInArrow(
        texts, "page_id long, url string, text string, n_chars long"
    )
