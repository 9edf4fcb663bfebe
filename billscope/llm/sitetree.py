"""HTML extraction with a site style tree.

The DOMs of a host's pages are merged by path (tags with their classes). A path's presentation (the run of child tags)
and content (the text below it) are spread over the host's pages; where they are the same on nearly all pages, their
entropy is low and so is the branch's importance. Branches of low importance are cut from each page, together with
the parts whose tag, role or class names them as no article (menus, adverts, forms, comments) unless they wrap the page. Names
that articles have as well (notice, related, a menu's review) only lessen a branch's importance, and count where it is mostly links.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.common import pieces, written

# HTML element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe textarea title".split())  # hold no elements: read up to their end tag
FOREIGN = frozenset(("svg", "math"))  # "/>" ends these and what is in them
EMBEDDED = frozenset("noscript template object".split()) | FOREIGN
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
CLOSED_BY_LIKE = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "thead": "tr td th", "tbody": "tr td th thead tbody", "tfoot": "tr td th tbody"}
SCOPE = frozenset("ul ol dl table article section div body html main nav aside form select".split())
# What is no text of the page, and what names a part that is likely no article.
NO_TEXT = frozenset("head canvas audio video".split()) | RAW | EMBEDDED
NOISE_TAGS = frozenset("nav aside form footer button select dialog menu search".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog form menu menubar toolbar".split())
SOFT_ROLES = frozenset("alert status".split())
ADVERT_NAMES = frozenset("ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promos promoted".split())
FIRM_NAMES = ADVERT_NAMES | frozenset(
    "consent gdpr nav navbar navigation topnav subnav breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer footnav topbar toolbar "
    "commentlist disqus newsletter popup modal searchform pagination pager".split()
)
LOOSE_NAMES = frozenset(  # beside a word of the subject they speak of the text: menu-review, code-comment
    "banner banners promotion cookie cookies menu menus side foot header masthead comment comments reply replies subscribe subscription signup "
    "overlay login register".split()
)
NOISE_NAMES = FIRM_NAMES | LOOSE_NAMES
SOFT_NAMES = frozenset(  # words of articles too: they count where the whole name is made of them
    "notice notices notification alert announcement disclaimer rail respond discussion share sharing shares social follow related recommended "
    "recommendations trending popular search skip".split()
)
PLAIN_NAMES = frozenset(
    "area article articles bar block box button buttons container content form icon icons inner item items link links list main media outer "
    "page panel post posts row section site stories story to top us wrap wrapper "
    "author big body bottom count date head heading id left meta primary right secondary slot small text thread title".split()
)
SOFT_OR_PLAIN = SOFT_NAMES | PLAIN_NAMES
ARTICLE_WORDS = frozenset("article entry post story".split())  # their header is the article's
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PART_NAMES = frozenset("ad ads advert comment comments reply replies promo related recommended sponsor sponsored teaser".split())
LAYOUT_WORDS = frozenset("with has have no without is".split())
MAIN_TAGS = frozenset(("article", "main"))
TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>", re.S
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
SPLIT_NAME = re.compile(r"[^a-z]+")
CAMEL = re.compile(r"([a-z])([A-Z])")
SPACE = re.compile(r"\s+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

DOUBT = 0.75  # what is seen on n distinct pages counts as seen on so many fewer: the correction for few pages
LEAST_BRANCH = 0.1  # importance below which a branch goes
LEAST_CONTENT = 0.05  # importance below which one content node goes
CONTENT_SHARE = 0.9  # weight of content against presentation
SOFT_PRIOR = 0.5  # factor on the importance of a branch that is softly named on all its pages
MOST_LINKED = 0.5  # share of link text from which a softly named part goes
FORM_SHARE = 0.5  # share of a page's text from which a form is what wraps the page
WRAPPER_SHARE = 0.9  # the same for a part with a name of noise
MAIN_SHARE = 0.5  # share of what is left of the page from which its article and main parts stand for all of it
ODD = 0x9E3779B97F4A7C15  # base of the hashes of block sequences
MASK = (1 << 64) - 1
KEPT, SOFT, NAMED, FORM, NEVER = range(5)  # what tag, role, class and id say of a part


@dataclass
class Node:
    tag: str
    path: int
    parent: int
    main: bool
    named: int = 0  # what it is named itself, not what holds it
    linked: int = 0  # characters of links of the branch
    noise: bool = False
    hidden: bool = False  # no text of the page, so no part of the tree
    children: list[str] = field(default_factory=list)


_paths: dict[tuple[int, str], int] = {}


def path_of(parent: int, name: str) -> int:
    key = parent, name
    found = _paths.get(key)
    if found is None:
        if len(_paths) > 100_000:
            _paths.clear()
        found = _paths[key] = signed(f"{parent}>{name}")
    return found


def signed(text: str) -> int:
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value


def attributes_of(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return out


def named(tag: str, attributes: dict[str, str], inside_main: bool) -> int:
    """What tag, role, class and id say of a part."""
    if tag in NO_TEXT:
        return NEVER
    if attributes and ("hidden" in attributes or UNSEEN.search(attributes.get("style", ""))):
        return NEVER
    if attributes.get("aria-hidden") == "true" and tag not in INLINE:  # inline ones are there to be seen
        return NEVER
    roles = attributes.get("role", "").lower().split() if attributes else ()
    if tag == "form" or "form" in roles:
        return FORM
    if tag in NOISE_TAGS or tag == "header" and not inside_main or NOISE_ROLES.intersection(roles):
        return NAMED
    if not attributes:
        return KEPT
    most = SOFT if SOFT_ROLES.intersection(roles) else KEPT
    if tag in ("html", "body"):
        return most
    classes, ids = attributes.get("class", "").split(), attributes.get("id", "").split()
    for name in classes + ids * (tag not in HEADINGS):
        words = [word for word in SPLIT_NAME.split(CAMEL.sub(r"\1-\2", name).lower()) if word]
        if not words or words[0] in LAYOUT_WORDS:
            continue
        if tag in MAIN_TAGS and words[0] not in PART_NAMES:  # its names may speak of the layout around it
            continue
        found = NOISE_NAMES.intersection(words)
        if tag in MAIN_TAGS:
            found &= {words[0]}
        if "header" in found and ARTICLE_WORDS.intersection(words):
            found -= {"header"}
        if found and not (inside_main and found <= {"header", "side"}):
            of_subject = found <= LOOSE_NAMES and not (found | SOFT_OR_PLAIN).issuperset(words)
            heads = inside_main and name not in classes and (tag == "section" or "section" in classes)
            if not (of_subject or heads):  # ids of an article's sections are made from their headings
                return NAMED
            most = SOFT
        elif SOFT_NAMES.intersection(words) and SOFT_OR_PLAIN.issuperset(words):
            most = SOFT
    return most


def mutes(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an inline element's text is no text of the page: not to be seen, or an advert."""
    if not attributes:
        return False
    names = {word for key in ("class", "id") for word in SPLIT_NAME.split(CAMEL.sub(r"\1-\2", attributes.get(key, "")).lower())}
    return "hidden" in attributes or bool(UNSEEN.search(attributes.get("style", ""))) or bool(ADVERT_NAMES & names)


def settle(nodes: list[Node], blocks: list[tuple[int, str]], unclosed: set[int]) -> None:
    """Decide from names, links and shares of the text which elements are noise on their page."""
    sizes = [0] * len(nodes)
    for holder, text in blocks:
        sizes[holder] += len(text)
    for i, node in enumerate(nodes[1:], 1):
        if i in unclosed:
            node.named = KEPT
        node.hidden = nodes[node.parent].hidden or node.named == NEVER
        if node.hidden:
            sizes[i] = node.linked = 0
    for i in range(len(nodes) - 1, 0, -1):
        sizes[nodes[i].parent] += sizes[i]
        nodes[nodes[i].parent].linked += nodes[i].linked
    for i, node in enumerate(nodes[1:], 1):
        own = node.hidden
        if node.named == SOFT:
            own = node.linked > MOST_LINKED * sizes[i]
        elif node.named in (NAMED, FORM):
            wraps = sizes[i] > (FORM_SHARE if node.named == FORM else WRAPPER_SHARE) * sizes[0] and node.tag not in NOISE_TAGS - {"form"}
            own = not (wraps and node.linked <= MOST_LINKED * sizes[i])
        node.noise = nodes[node.parent].noise or own


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Elements of a page and its blocks of text, each with the number of the element that holds it.

    Omitted end tags are filled in for paragraphs, list items and table cells; a stray ``<`` is text. An embedded part
    without an end tag of its own (``<object>``, ``<noscript>``, ``<svg>``, ...) is read as empty: what follows is the page's.
    """
    nodes = [Node("", 0, -1, False)]
    blocks: list[tuple[int, str]] = []
    stack, parts, holder, at = [0], [], 0, 0
    firm = [0]  # for each place of the stack the last place that holds no inline element
    opened: Counter[str] = Counter()  # elements of a kind on the stack
    muted: set[int] = set()  # open inline elements whose text does not count
    unclosed: set[int] = set()
    ends_at: dict[str, int] = {}  # where the last end tag of a kind starts

    def flush() -> None:
        nonlocal parts
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                blocks.append((holder, text))
            parts = []

    def close(index: int, own: bool = False) -> None:
        if firm[-1] >= index:
            flush()
        unclosed.update(i for i in stack[index + own :] if nodes[i].tag in EMBEDDED)
        opened.subtract(nodes[i].tag for i in stack[index:])
        muted.difference_update(stack[index:])
        del stack[index:], firm[index:]

    def comes_end(tag: str) -> bool:
        if tag not in ends_at:
            ends_at[tag] = max((m.start() for m in re.finditer(rf"</{tag}\b", page, re.I)), default=-1)
        return ends_at[tag] >= at

    size = len(page)
    while at < size:
        token = TOKEN.search(page, at)
        if token is None:
            text, after = page[at:], size
        else:
            text, after = page[at : token.start()], token.end()
        if text and not muted:
            if not parts:
                holder = stack[firm[-1]]
            parts.append(text)
            if opened["a"]:
                nodes[holder].linked += len(text.strip())
        at = after
        if token is None or not (token[2] or token[5]):
            continue
        ends, tag, raw = (token[1], token[2].lower(), token[3]) if token[2] else (token[4], token[5].lower(), token[6])
        if ends:
            if opened[tag]:
                close(next(index for index in range(len(stack) - 1, 0, -1) if nodes[stack[index]].tag == tag), True)
            elif tag == "p":
                flush()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in CLOSES_PARAGRAPH:
            if nodes[stack[firm[-1]]].tag == "p":
                close(firm[-1])
        elif tag in CLOSED_BY_LIKE and any(opened[like] for like in CLOSED_BY_LIKE[tag].split()):
            like = CLOSED_BY_LIKE[tag].split()
            for index in range(len(stack) - 1, 0, -1):
                name = nodes[stack[index]].tag
                if name in like:
                    close(index)
                    if tag in ("li", "dt", "dd", "td", "th", "option") or name in ("tr", "tbody", "thead"):
                        break
                elif name in SCOPE:
                    break
        if tag not in INLINE:
            flush()
        parent = nodes[stack[-1]]
        attributes = attributes_of(raw) if raw.strip(" /") else {}
        name = tag + "." + ".".join(sorted(re.sub(r"\d+", "0", attributes["class"]).split())) if attributes.get("class") else tag
        node = Node(tag, path_of(parent.path, name), stack[-1], parent.main or tag in MAIN_TAGS, named(tag, attributes, parent.main))
        parent.children.append(name)
        nodes.append(node)
        if tag in VOID:
            if tag not in INLINE:
                flush()
            continue
        empty = raw.rstrip().endswith("/")
        if tag in RAW and not (empty and any(nodes[i].tag in FOREIGN for i in stack)):
            if comes_end(tag):
                at = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at).end()
            elif tag in ("script", "style"):
                at = size
            continue
        if not empty:
            stack.append(len(nodes) - 1)
            firm.append(firm[-1] if tag in INLINE else len(stack) - 1)
            opened[tag] += 1
            if tag in INLINE and mutes(tag, attributes):
                muted.add(stack[-1])
    close(1)
    flush()
    settle(nodes, blocks, unclosed)
    return nodes, blocks


def block_hash(text: str) -> int:
    """The hash of a sequence of one block."""
    return (xxhash.xxh64_intdigest(text) | 1) - (1 << 63)


def contents_of(nodes: list[Node], blocks: list[tuple[int, str]]) -> dict[int, int]:
    """A hash of the sequence of blocks below each element that has any, in time that does not grow with the depth.

    A branch's blocks follow each other on the page, so sums of block hashes times powers of their places are added up
    from child to parent, then moved to the place of the branch's first block.
    """
    sums: dict[int, int] = {}
    first: dict[int, int] = {}
    powers = [1]
    for k, (holder, text) in enumerate(blocks):
        if not nodes[holder].hidden:
            sums[holder] = (sums.get(holder, 0) + (xxhash.xxh64_intdigest(text) | 1) * powers[k]) & MASK
            first.setdefault(holder, k)
        powers.append(powers[k] * ODD & MASK)
    for i in range(len(nodes) - 1, 0, -1):
        if i in sums:
            parent = nodes[i].parent
            sums[parent] = (sums.get(parent, 0) + sums[i]) & MASK
            first[parent] = min(first.get(parent, first[i]), first[i])
    back, inverse = [1], pow(ODD, -1, 1 << 64)
    for _ in blocks:
        back.append(back[-1] * inverse & MASK)
    return {i: (value * back[first[i]] & MASK) - (1 << 63) for i, value in sums.items()}


PRESENTATION, CONTENT, PRESENCE, SOFTLY, BLOCK = range(5)


def observations(page: str) -> tuple[bytes, set[tuple[int, int, int]]]:
    """A digest of the page's text without named noise, by which equal pages are known, and what the page tells about its
    host's tree: (path, kind, value), each once. A BLOCK is a text the page may lose as a low content node."""
    nodes, blocks = parse(page)
    digest = xxhash.xxh3_128()
    for holder, text in blocks:
        if not nodes[holder].noise:
            digest.update(f"{nodes[holder].path}>{text}\n")
    contents = contents_of(nodes, blocks)
    seen = {(0, BLOCK, block_hash(text)) for holder, text in blocks if not nodes[holder].noise}
    for i, node in enumerate(nodes[1:], 1):
        if node.hidden or node.tag in INLINE or node.tag in ("html", "body"):
            continue
        runs = [tag for k, tag in enumerate(node.children) if tag not in INLINE and (not k or node.children[k - 1] != tag)]
        seen.add((node.path, PRESENTATION, signed(" ".join(runs))))
        seen.add((node.path, PRESENCE, 0))
        if node.named == SOFT:
            seen.add((node.path, SOFTLY, 0))
        if i in contents:
            seen.add((node.path, CONTENT, contents[i]))
    return digest.digest(), seen


def main_text(page: str, branches: frozenset[int] | set[int], contents: frozenset[int] | set[int]) -> str:
    """The page's blocks without named noise and without branches or content nodes of low importance.

    Where article or main parts hold at least half (``MAIN_SHARE``) of the characters then left, they stand for the page;
    a teaser in an article of its own does not displace the text beside it. Each branch is cut or kept by its own
    importance, whatever share of the page it has.
    """
    nodes, blocks = parse(page)
    low = [False] * len(nodes)
    if branches:
        for i, node in enumerate(nodes[1:], 1):
            low[i] = low[node.parent] or node.path in branches
    kept = [(holder, text) for holder, text in blocks if not (nodes[holder].noise or low[holder] or contents and block_hash(text) in contents)]
    main = [(holder, text) for holder, text in kept if nodes[holder].main]
    if main and sum(len(text) for _, text in main) >= MAIN_SHARE * sum(len(text) for _, text in kept):
        kept = main
    return "\n\n".join(text for _, text in kept)


def host_of(url: str):
    return F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][-+.A-Za-z0-9]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


OBSERVED = pa.struct([("path", pa.int64()), ("kind", pa.int32()), ("value", pa.int64())])


def observed(pages: DataFrame) -> DataFrame:
    """``host``, ``key`` (of the html), ``page`` (digest of the text) and ``seen`` (observations) of each page, written once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            found = [observations(page) for page in batch.column("html").to_pylist()]
            offsets = np.cumsum([0, *(len(seen) for _, seen in found)])
            path, kind, value = zip(*(row for _, seen in found for row in seen)) if offsets[-1] else ((), (), ())
            flat = pa.StructArray.from_arrays([pa.array(path, pa.int64()), pa.array(kind, pa.int32()), pa.array(value, pa.int64())], fields=list(OBSERVED))
            yield pa.RecordBatch.from_pydict(
                {
                    "host": batch.column("host"),
                    "key": batch.column("key"),
                    "page": pa.array([digest for digest, _ in found], pa.binary()),
                    "seen": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                }
            )

    rows = pages.where("host != '' and html is not null").select("host", "key", "html")
    return written(rows.mapInArrow(run, "host string, key binary, page binary, seen array<struct<path: long, kind: int, value: long>>"), "observed")


def site_trees(seen: DataFrame) -> DataFrame:
    """``host, path, kind, value`` of the low branches (PRESENCE) and low content nodes (BLOCK) of each host's merged tree.

    Pages of a host with equal text are one page of its tree, so an article that is there in copies is not what repeats.
    Importance of a path seen on m pages: content counts 1 minus the mean of log n / log m over its contents, each
    seen on n pages, presentation the entropy of its child runs to base m. n is taken ``DOUBT`` smaller in the logarithm,
    which matters for few pages only: something on all pages of a host is low from six distinct pages on. A soft name
    (``SOFT_NAMES``) lessens the importance of its branch. Counts are summed
    in each task before they are shuffled, and no task gathers a host's pages.
    """
    distinct = seen.groupBy("host", "page").agg(F.first("seen").alias("seen")).select("host", F.inline("seen")).where(F.col("kind") != BLOCK)
    counted = written(distinct.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n")), "tree")
    n = F.col("n").cast("double")
    log_n = F.log(F.greatest(n - DOUBT, F.lit(1.0)))
    is_kind = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value).otherwise(0.0))
    paths = counted.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == PRESENCE, F.col("n"))).alias("m"),
        F.coalesce(F.max(F.when(F.col("kind") == SOFTLY, F.col("n"))), F.lit(0)).alias("soft"),
        is_kind(PRESENTATION, n * log_n).alias("presented"),
        is_kind(CONTENT, n).alias("contents"),
        is_kind(CONTENT, n * log_n).alias("repeated"),
    )
    m = F.col("m").cast("double")
    presentation = 1 - F.col("presented") / (m * F.log(m))
    content = F.when(F.col("contents") > 0, 1 - F.col("repeated") / (F.col("contents") * F.log(m))).otherwise(0.0)
    prior = 1 - (1 - SOFT_PRIOR) * F.col("soft") / m
    known = paths.where(F.col("m") > 1).withColumn("importance", prior * ((1 - CONTENT_SHARE) * presentation + CONTENT_SHARE * content))
    low_paths = known.where(F.col("importance") < LEAST_BRANCH).select("host", "path", F.lit(PRESENCE).alias("kind"), F.lit(0).cast("long").alias("value"))
    low_contents = (
        counted.where((F.col("kind") == CONTENT) & (F.col("n") > 1))
        .join(known.select("host", "path", "m"), ["host", "path"])
        .where(1 - log_n / F.log(F.col("m").cast("double")) < LEAST_CONTENT)
        .select("host", F.lit(0).cast("long").alias("path"), F.lit(BLOCK).alias("kind"), "value")
        .distinct()
    )
    return low_paths.unionAll(low_contents)


def page_cuts(seen: DataFrame, low: DataFrame) -> DataFrame:
    """``host, key, branches, contents``: what of its host's low branches and content nodes each page has, if any.

    A host may have any number of low branches; a page only meets its own, so no row is longer than a page.
    """
    parts = seen.select("host", "key", F.inline("seen")).where(F.col("kind").isin(PRESENCE, BLOCK)).join(low, ["host", "path", "kind", "value"])
    of_kind = lambda kind, column: F.collect_set(F.when(F.col("kind") == kind, F.col(column)))
    return parts.groupBy("host", "key").agg(of_kind(PRESENCE, "path").alias("branches"), of_kind(BLOCK, "value").alias("contents"))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` (blocks joined by two line ends) and ``n_chars`` of every page.

    A null or empty page has an empty text. A page whose url is null or names no host is cleaned without a tree. Repeated
    pages come out repeated (and count as one page of their host), an empty table gives an empty result, other columns
    are ignored.
    """
    rows = pages.select("page_id", "url", F.col("html"), F.coalesce(host_of("url"), F.lit("")).alias("host"), F.unhex(F.md5("html")).alias("key"))
    seen = observed(rows)
    cuts = written(page_cuts(seen, written(site_trees(seen), "low")), "cuts")
    joined = rows.join(cuts, ["host", "key"], "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            texts = [
                main_text(page or "", set(branches or ()), set(contents or ()))
                for page, branches, contents in zip(*(batch.column(c).to_pylist() for c in ("html", "branches", "contents")))
            ]
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(text) for text in texts], pa.int64())})

    kind = dict(pages.dtypes)["page_id"]
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
