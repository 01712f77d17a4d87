"""Main text of web pages as the best contiguous stretch of a page.

A page is read once, left to right, as words and tags, each in the block that holds it. A word
scores what words in such blocks were found to be worth in labelled pages: above 0 where they
mostly belong to the article, below 0 where they do not. Tags cost. The stretch with the largest sum, found
in one linear scan, is the article; its blocks of article kind are the text, each whole.

Labelled pages are those that mark their article themselves (``article`` or ``main``). The scorer sees the
marks only where a class, an id or a form would speak against all that they hold. A bounded sample of labelled
pages is counted, over word counts by block kind; kinds that no labelled page has keep the prior of their name.

NULL, empty and text-free pages give the empty text. Ties go to the earliest, then the shortest
stretch. Very long pages, unclosed tags and deep nesting take time linear in the page; a tag that the page's end
cuts off is no text. Every page is read by itself; repeated rows give equal results, and an empty table
gives no rows. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankscope.llm.common import strings

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav "
    "noscript object ol option p pre search section select summary table tbody td template textarea tfoot "
    "th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKS = frozenset(("article", "main"))
HIDDEN = frozenset(
    "aside button dialog fieldset footer head iframe label legend menu nav noscript object option "
    "search select template textarea title".split()
)
_NAME = (
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|"
    r"newsletter|subscribe|signup|login|sidebar|side|widget|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|"
    r"(?:site|page|top)[-_]?header|masthead|topbar|footer|bottom|copyright|comments?|commentlist|replies|reply|respond|disqus|"
    r"share|sharing|social|follow|related|recommend\w*|trending|popular|tags|toc|search|form|hidden)"
)
_PLACE = r"(?:area|bar|block|box|container|inner|item|left|list|right|section|wrap|wrapper|[0-9]+)"
#: a whole class or id: such names only, with words that say where or what kind of box
HIDDEN_NAMES = re.compile(rf"(?:{_PLACE}[-_])*{_NAME}(?:[-_](?:{_NAME}|{_PLACE}))*")
NEVER_NAMED = MARKS | {"html", "body"}
HIDDEN_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu".split())

#: attributes up to the tag's end; nothing in them is read twice
_INSIDE = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
#: a tag ends at ``>`` outside quotes, where quotes are open at any ``>``, and else with the page
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|math)\b(?:{_INSIDE}>|[^>]*+>)"
    r"(?:.*?</(?P=raw)\s*>|.*)"
    rf"|<(?P<close>/)?(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>{_INSIDE}(?=>|\Z)|[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

Weights = dict[str, float]
TAG_COST = -1.0
HIDDEN_COST = -0.02
PRIOR = 2.0
#: worth of a word before any page is seen where only a class or id speaks against it
NAMED_PRIOR = -0.5
#: most that words in a row cost together where a name or a form speaks against them: such a box inside an
#: article does not part it, if enough follows
NAMED_MOST = 30.0
#: forms, then names are overruled where the page without them has a stretch worth so many times more
FORM_OUTVOTED, OUTVOTED = 2.0, 10.0
#: how an element is hidden: not, by a form around it, by a class or id, by its tag or what it declares
SHOWN, FORMED, NAMED, HARD = 0, 1, 2, 3
SIGNS = ("", "+", "-", "~")
SIGNED = ("+", "-", "~")


def _hidden(name: str, attrs: str) -> tuple[int, str]:
    """How an element's name or attributes say that it is not article text, and its first class."""
    first, named, formed = "", False, name == "form"
    hidden = name in HIDDEN
    if attrs and "=" in attrs or "hidden" in attrs:
        for key, *values in ATTRIBUTE.findall(attrs):
            key, value = key.lower(), next((v for v in values if v), "").lower()
            if key in ("class", "id"):
                first = first or value.split(" ")[0][:40]
                named = named or any(map(HIDDEN_NAMES.fullmatch, value.split()))
            elif key == "role":
                hidden = hidden or value in HIDDEN_ROLES
                formed = formed or value == "form"
            elif key == "hidden" or key == "aria-hidden" and value == "true":
                hidden = True
            elif key == "style":
                hidden = hidden or "display:none" in value.replace(" ", "")
    if hidden:
        return HARD, first
    if name in NEVER_NAMED:
        return SHOWN, first
    return NAMED if named else FORMED if formed else SHOWN, first


def segments(page: str) -> Iterator[tuple[str, str, bool, bool]]:
    """The page as (text or tag, kind of its block, whether it is marked as article, whether a tag).

    A kind is the block's tag, its first class if it has one, ``~`` in front inside an element that
    is hidden by its tag or attributes, ``-`` inside one whose class or id speaks against it, ``+`` inside a form (both
    unless an ``article`` or ``main`` lies between), and ``>a`` behind inside a link. Tags that end no block are left out.
    """
    stack: list[tuple[str, int, bool, str]] = [("", SHOWN, False, "body")]
    opened: Counter = Counter()  # elements on the stack by name
    links = 0
    last = 0

    def kind() -> str:
        top = stack[-1]
        return SIGNS[top[1]] + top[3] + (">a" if links else "")

    for found in TOKEN.finditer(page):
        if found.start() > last:
            yield page[last : found.start()], kind(), stack[-1][2], False
        last = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if name == "a":
            links = 0 if found["close"] else 1
            continue
        if name == "br":
            yield " ", kind(), stack[-1][2], False
            continue
        if name not in BLOCKS:
            if not found["close"] and name not in VOID:
                hidden, _ = _hidden(name, found["attrs"])
                if hidden and not found["attrs"].rstrip().endswith("/"):
                    top = stack[-1]
                    stack.append((name, max(top[1], hidden), top[2], name))
                    opened[name] += 1
                    continue
            elif found["close"] and len(stack) > 1 and stack[-1][0] == name:
                stack.pop()
                opened[name] -= 1
            continue
        links = 0
        if found["close"]:
            while opened[name]:
                ended = stack.pop()[0]
                opened[ended] -= 1
                if ended == name:
                    break
        elif name not in VOID:
            if stack[-1][0] == "p" or name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1][0] == name:
                opened[stack.pop()[0]] -= 1
            hidden, first = _hidden(name, found["attrs"])
            above = stack[-1]
            if name == "header" and not above[2]:
                hidden = HARD
            marked = above[2] or name in MARKS
            shown = above[3] if name in MARKS or name in ("html", "body") else name + ("." + first if first else "")
            over = SHOWN if name in MARKS and above[1] in (FORMED, NAMED) else above[1]
            stack.append((name, max(over, hidden), marked, shown))
            opened[name] += 1
        yield name, kind(), stack[-1][2], True
    if last < len(page):
        yield page[last:], kind(), stack[-1][2], False


def prior(kind: str) -> float:
    """Worth of a word before any page is seen. Links in a paragraph speak neither for nor against it."""
    if kind.endswith(">a"):
        return 0.0 if kind.removesuffix(">a").split(".")[0] == "p" else -PRIOR
    if kind.startswith("~"):
        return -PRIOR
    return NAMED_PRIOR if kind.startswith(("+", "-")) else PRIOR


def weight(kind: str, weights: Weights) -> float:
    return weights.get(kind, prior(kind))


def formless(kind: str, weights: Weights) -> float:
    """Worth of a word where forms say nothing that the labelled pages have not shown."""
    return weight(kind if kind in weights else kind.removeprefix("+"), weights)


def nameless(kind: str, weights: Weights) -> float:
    """Worth of a word where neither forms nor names say anything that the labelled pages have not shown."""
    return weight(kind if kind in weights else kind.removeprefix("+").removeprefix("-"), weights)


def _counts(pages: Iterator[str]) -> Counter:
    """Words and tags by (what, kind, marked) over the pages that mark an article."""
    counts: Counter = Counter()
    for page in pages:
        own: Counter = Counter()
        for content, kind, marked, tag in segments(page):
            own["tag" if tag else "word", kind, marked] += 1 if tag else len(content.split())
        if any(marked for _, _, marked in own):
            counts.update(own)
    return counts


def learn(pages: DataFrame, html: str = "html", most_pages: int = 2000) -> Weights:
    """Worth of words by block kind: the log odds of lying in a marked article.

    At most ``most_pages`` different pages are counted, those with the smallest hash. Only hashes and counts are
    shuffled: pages are read where they lie, equal ones once in a task, and count once. Kinds
    that hold less than one word in a hundred thousand keep their prior, which bounds the table.
    """
    marked = pages.filter(F.lower(html).rlike("<(article|main)[ >]")).select(
        F.xxhash64(html).alias("hash"), F.col(html).alias("html")
    )
    smallest = marked.select("hash").distinct().orderBy("hash").limit(most_pages)
    last = smallest.agg(F.max("hash")).first()[0]
    if last is None:
        return {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for key, page in zip(batch.column("hash").to_pylist(), batch.column("html"), strict=True):
                if key not in seen:
                    seen.add(key)
                    counts = _counts(iter([page.as_py()]))
                    rows += [(key, kind, inside, n) for (what, kind, inside), n in counts.items() if what == "word"]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*rows, strict=True)], ["hash", "kind", "inside", "n"]
                )

    counted = marked.filter(F.col("hash") <= last).mapInArrow(run, "hash long, kind string, inside boolean, n long")
    words = counted.distinct().groupBy("kind").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"), F.sum("n").alias("n")
    )
    found = {r["kind"]: (r["inside"], r["n"]) for r in words.orderBy(F.desc("n"), "kind").limit(10_000).collect()}
    total = sum(n for _, n in found.values())
    out = {}
    for kind, (inside, n) in found.items():
        if n * 100_000 >= total and n > 0:
            likely = 50 if prior(kind) > 0 else 0
            odds = math.log((inside + likely + 0.5) / (n - inside + 50 - likely + 0.5))
            out[kind] = max(-6.0, min(6.0, odds))
    return out


Worth = Callable[[str, Weights], float]


def _best(parts: list[tuple[str, str, bool]], weights: Weights, worth_of: Worth) -> tuple[float, tuple[int, int]]:
    """The largest sum of a stretch, and where it lies, drawn out to whole blocks."""
    best, best_span, total, start, spent = 0.0, (0, 0), 0.0, 0, 0.0
    for i, (content, kind, tag) in enumerate(parts):
        if tag:
            cheap = kind.startswith(SIGNED) or worth_of(kind, weights) > 0
            total += TAG_COST / 10 if cheap else TAG_COST
        elif words := len(content.split()):
            # what is hidden by its tag is never text, so it hardly parts a stretch
            value = words * (HIDDEN_COST if kind.startswith("~") else worth_of(kind, weights))
            if value < 0 and kind.startswith(("+", "-")):
                value = max(value, spent - NAMED_MOST)
                spent -= value
            elif not kind.startswith("~"):
                spent = 0.0
            total += value
        if total <= 0:
            total, start, spent = 0.0, i + 1, 0.0
        elif total > best:
            best, best_span = total, (start, i + 1)
    start, end = best_span
    while end and start and not parts[start - 1][2]:
        start -= 1
    while end and end < len(parts) and not parts[end][2]:
        end += 1
    return best, (start, end)


def extract_text(page: str, weights: Weights) -> str:
    """The article of one page, its blocks two line ends apart.

    A class, an id or a form only lowers the worth of words: kinds that labelled pages show in articles count as
    such, and where nearly all that a page says stands under such names or in forms, they are overruled.
    """
    parts = [(entities.unescape(x) if not tag else "", k, tag) for x, k, _, tag in segments(page)]
    worth_of: Worth = weight
    best, best_span = _best(parts, weights, weight)
    for sign, without, factor in (("+", formless, FORM_OUTVOTED), ("-", nameless, OUTVOTED)):
        if any(kind.startswith(sign) for _, kind, _ in parts):
            other, other_span = _best(parts, weights, without)
            if other > factor * best:
                worth_of, best, best_span = without, other, other_span
    blocks: list[str] = []
    held: list[str] = []
    for content, kind, tag in [*parts[slice(*best_span)], ("", "", True)]:
        if tag:
            if block := " ".join("".join(held).split()):
                blocks.append(block)
            held = []
        elif not kind.startswith("~") and worth_of(kind.removesuffix(">a"), weights) > 0:
            held.append(content)
    return "\n\n".join(blocks)


def extract(
    pages: DataFrame, weights: Weights, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """One row per page: key, url, the main text and its length in code points."""
    source = pages.select(pages[key].alias("key"), pages[url].alias("url"), pages[html].alias("html"))
    names = [key, url, "text", "n_chars"]
    kinds = [source.schema[n].dataType.simpleString() for n in ("key", "url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract_text(page, weights) for page in strings(batch, "html")]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("url"), pa.array(texts, pa.string()), sizes], names
            )

    return source.mapInArrow(run, f"`{key}` {kinds[0]}, `{url}` {kinds[1]}, text string, n_chars long")
