"""Main text of web pages from the template that pages of one host share.

A structural token is a block element by its path of block names, classes and ids. Its occurrence
vector says how often each page of the host has it. Tokens with the same vector form an equivalence
class. A class is valid if all its tokens are on the same pages, on two or more and on more than a
tenth of the host's, and each is there once but for a few odd pages. Valid classes nest by
containment: a class lies in the slot (from its open to its close tag) of the token of another
class that encloses it; layouts of one host are classes side by side, and a page follows those it has.

What varies decides: a token whose own text is the same on all its pages is template text and
counts nothing. From the root, a page goes down to the nested slot that holds most of what is left
of the text outside links, while that is ``SHARE`` of it and no heading that varies stays outside.
Names break ties: where no slot holds so much, the one with a name of an article is taken; a sole
``article`` or ``main`` element is always followed, and nothing inside an ``article`` is left out but
boilerplate. Text that a slot of the whole page would keep though it is the same on every page of
the host is left out; inside an article it stays.

Boilerplate is what its element's kind says (nav, footer, form, ...) or its names. Inside an
article or main a name counts only if all its words speak of boilerplate (``comment-list``, not
``related-work``), or if its text is the same on all pages of the host; those two elements are never struck by name.

Vectors are never stored: each token adds up a random number of every page times its count there,
twice, so equal vectors have equal sums, and any number of pages of a host is one aggregate row.

Defined results: a NULL or empty page gives an empty text; a page whose url has no host, whose
host has no other page, or that lacks its host's tokens is read by the same rule on its own. Equal
rows give equal results. Other columns are kept (one named ``main_text`` is replaced).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.llm.common import Stages, slices

# Kinds of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCKS = frozenset(("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
                    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
                    "thead tr ul").split())
CLOSES_P = BLOCKS - frozenset("td th tr tbody thead tfoot".split())
# Names that mark a part as no article text, or as the article.
NOT_TEXT = frozenset("nav footer aside form button select option svg canvas object map dialog menu head".split())
BOILER = re.compile(r"(?:^|[-_ ])(?:ads?|adverts?|advertisement|advertising|banner|sponsor(?:ed)?|promo(?:tion)?|sidebar|side|menu|nav(?:bar|igation)?|"
                    r"breadcrumbs?|cookies?|consent|notice|popup|modal|comments?|replies|discussion|respond|share|sharing|social|"
                    r"newsletter|subscribe|related|recommended|footer|header|masthead|toolbar|widget|login|search|contentinfo|complementary)(?:$|[-_ 0-9])", re.I)
# Words that beside one of those leave a name boilerplate.
NEUTRAL = re.compile(r"(?:area|articles?|bar|block|body|bottom|box|buttons?|container|content|entry|form|inline|inner|item|left|links?|list|panel|"
                     r"posts?|reader|readers|right|section|signup|site|slot|stories|thread|top|unit|user|wrap|wrapper|[0-9#]*)", re.I)
ARTICLE = re.compile(r"(?:^|[-_ ])(?:article|content|main|post|story|entry|body-text)(?:$|[-_ ])", re.I)

STEADY = 0.8  # of the pages that have a token, the share that must have it once
LAYOUT = 10  # a further layout has more than one page in so many
SHARE = 0.7  # of the text of a slot, what a slot inside must hold to be entered

# quotes count only right after "="; a value without them runs to a blank or ">"
VALUE = r"""(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>"'][^\s>]*)"""
TAG = re.compile(rf"""<(?:!--(?P<comment>-?>|.*?(?:--!?>|\Z))|(?P<other>[!?][^>]*)(?:>|\Z)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"""
                 rf"""(?P<rest>(?:[^>=]|=\s*{VALUE}?)*)(?P<closed>>|\Z))""", re.S)
ATTRIBUTE = re.compile(rf"""([^\s=/>]+)(?:\s*=\s*({VALUE}))?""")


def marks_of(rest: str) -> str:
    """The values of class, id and role in order, digits as one sign."""
    out, seen = [], set()
    for name, value in ATTRIBUTE.findall(rest):
        name = name.lower()
        if name in ("class", "id", "role") and name not in seen:
            seen.add(name)
            out.append(value.strip(value[0]) if value[:1] in ("'", '"') else value)
    return re.sub(r"\d+", "#", " ".join(" ".join(out).split())).replace(">", "#")


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", name, marks) and ("close", name, ""); raw elements are skipped whole."""
    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if m is None:
            yield "text", page[at:], ""
            return
        if m.start() > at:
            yield "text", page[at:m.start()], ""
        at, name = m.end(), m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            yield "close", name, ""
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
        elif m["closed"]:
            yield "open", name, marks_of(m["rest"]) if m["rest"] else ""


def all_boilerplate(marks: str) -> bool:
    """Whether one of the names consists of boilerplate words, but for neutral ones."""
    return any(BOILER.search(mark) and all(BOILER.search(w) or NEUTRAL.fullmatch(w) for w in re.split(r"[-_]+", mark)) for mark in marks.split())


class Open:
    """One open element: the token of its innermost block, and whether it lies in boilerplate."""

    __slots__ = ("name", "path", "out", "link", "inside")

    def __init__(self, name: str, marks: str, above: Open | None, fixed: frozenset[str] | set[str]):
        self.name = name
        outer, inside = (above.path, above.inside) if above else ("", False)
        self.path = (outer and outer + ">") + name + (f".{marks}" if marks else "") if name in BLOCKS else outer
        self.inside = inside or name in ("article", "main")
        self.out = bool(above and above.out) or name in NOT_TEXT or (name == "header" and not inside)
        if not self.out and marks and name not in ("article", "main") and BOILER.search(marks):
            self.out = not inside or all_boilerplate(marks) or (name in BLOCKS and self.path in fixed)
        self.link = name == "a" or bool(above and above.link)


def walk(page: str, fixed: frozenset[str] | set[str] = frozenset()) -> Iterator[tuple[str, Open | None, str]]:
    """("in", element, ""), ("text", innermost element, text) and ("break", element, "") with implied ends."""
    stack: list[Open] = []
    for kind, value, marks in events(page):
        top = stack[-1] if stack else None
        if kind == "text":
            yield "text", top, value
        elif kind == "open":
            if value in VOID:
                yield ("break" if value == "hr" else "text"), top, " "
                continue
            if value in CLOSES_P or value == "li":
                implied = "li" if value == "li" else "p"
                for n in range(len(stack) - 1, -1, -1):
                    if stack[n].name == implied:
                        del stack[n:]
                        break
                    if stack[n].name in BLOCKS:
                        break
            if value in BLOCKS:
                yield "break", top, ""
            element = Open(value, marks, stack[-1] if stack else None, fixed)
            stack.append(element)
            yield "in", element, ""
        else:
            for n in range(len(stack) - 1, -1, -1):
                if stack[n].name == value:
                    del stack[n:]
                    break
            if value in BLOCKS:
                yield "break", stack[-1] if stack else None, ""


def above(path: str) -> Iterator[str]:
    """The paths that enclose a path, innermost first, at last the whole page."""
    while path:
        path = path.rpartition(">")[0]
        yield path


def slot_rank(path: str) -> int:
    """How clearly the last element of a path is named as the article; 0 for the whole page."""
    name, _, marks = path.rpartition(">")[2].partition(".")
    if name == "article":
        return 4
    return 3 if name == "main" or marks == "main" else 2 if ARTICLE.search(marks) and name != "body" else 1 if name else 0


class Token:
    """What a page has of a token: how often, its own text, and text outside and in links of the whole slot."""

    __slots__ = ("n", "own", "plain", "text", "links")

    def __init__(self):
        self.n, self.own, self.plain, self.text, self.links = 0, [], 0, 0, 0


def tokens(page: str, fixed: frozenset[str] | set[str] = frozenset()) -> dict[str, Token]:
    """Structural tokens of a page by path; "" is the page. Boilerplate has no text."""
    out = {"": Token()}
    out[""].n = 1
    for kind, element, value in walk(page, fixed):
        if kind == "in":
            if element.name in BLOCKS:
                out.setdefault(element.path, Token()).n += 1
        elif kind == "text" and not (element is not None and element.out):
            value = value.strip()
            if value:
                token = out[element.path if element is not None else ""]
                token.own.append(value)
                if element is not None and element.link:
                    token.links += len(value)
                else:
                    token.text += len(value)
                    token.plain += len(value)
    for path in sorted(out, key=len, reverse=True):  # a path is longer than what encloses it
        if path:
            outer = out[path.rpartition(">")[0]]
            outer.text += out[path].text
            outer.links += out[path].links
    return out


def extract(page: str | None, slot: str, fixed: frozenset[str] | set[str] = frozenset(), struck: frozenset[str] | set[str] = frozenset()) -> str:
    """Text of the slot without boilerplate and without what the ``struck`` tokens say themselves; the slot "" is the whole page."""
    if not page:
        return ""
    found: list[list[str]] = [[]]
    for kind, element, value in walk(page, fixed):
        if kind == "text":
            path = element.path if element is not None else ""
            if (slot == "" or path == slot or path.startswith(slot + ">")) and not (element is not None and element.out) and path not in struck:
                found[-1].append(value)
        elif kind == "break" and found[-1]:
            found.append([])
    blocks = (" ".join(html.unescape("".join(b)).split()) for b in found)
    return "\n".join(b for b in blocks if b)


def weigh(text: float, links: float) -> float:
    """Text outside links; negative where links outweigh it, as no article's slot does."""
    return float(text if text > 2 * links else -max(text, 0.5 if links else 0))


def descend(at: str, weights: dict[str, float], headings: list[str]) -> str:
    """The slot reached from a slot through the nested ones, by weight, and by names in ties."""
    inside: dict[str, list[str]] = {}
    for path in weights:
        if path and weights[path] > 0:
            # what encloses it and may be a slot itself; links may outweigh the text of a body
            inside.setdefault(next((p for p in above(path) if p == at or weights.get(p, 0) > 0), ""), []).append(path)
    while slot_rank(at) < 4:
        near = inside.get(at, ())
        named = [p for p in weights if slot_rank(p) >= 3 and slot_rank(p) > slot_rank(at) and weights[p] and (at == "" or p.startswith(at + ">"))]
        clearest = [p for p in named if slot_rank(p) == max(map(slot_rank, named))]
        if len(clearest) == 1:
            at = clearest[0]
            continue
        if not near:
            break
        best = max(near, key=lambda p: (weights[p], slot_rank(p), p))
        if weights[best] < SHARE * abs(weights.get(at, 0)):
            best = max(near, key=lambda p: (slot_rank(p), weights[p], p))
            if slot_rank(best) < 2:
                break
        if any((at == "" or h.startswith(at + ">")) and h != best and not h.startswith(best + ">") for h in headings):
            break
        at = best
    return at


def page_text(page: str | None, template: dict[str, float] | None = None, fixed: frozenset[str] | set[str] = frozenset()) -> str:
    """Text of a page by the template of its host: the weights of its tokens, and the tokens whose text is the host's."""
    if not page:
        return ""
    found = tokens(page, fixed)
    headings = [p for p, t in found.items() if p.rpartition(">")[2].partition(".")[0] in ("h1", "h2") and t.own and p not in fixed]
    known = template or {}
    slot = descend("", {p: known[p] for p in found if p in known}, headings) if known else ""
    if slot_rank(slot) < 2 and not (slot and slot.rpartition(">")[2].partition(".")[0] not in ("html", "body")):
        # no slot of the host's template leads on: the page's own tokens do
        own = {p: weigh(t.text, t.links) for p, t in found.items() if p == slot or (t.n == 1 and p not in known and p not in fixed)}
        slot = descend(slot, own, headings)
    whole = slot.rpartition(">")[2].partition(".")[0] in ("", "html", "body")
    return extract(page, slot, fixed, fixed if whole else frozenset())


def host_template(found: list[dict]) -> tuple[list[str], list[float], list[str]]:
    """Tokens of the valid classes with what varies in their slots on a page, and the tokens with the same text on all pages.

    ``found`` has, per token of a host, its path, vector sums, counts, own and whole text and whether its own text never changes.
    """
    steady = {t["path"] for t in found if t["same"] and t["own"] and t["in_pages"] >= 2}
    if all(t["path"] in steady for t in found if t["plain"]):  # copies of one page: nothing tells template from text
        steady = set()
    classes: dict[tuple[int, int], list[dict]] = {}
    for t in found:
        classes.setdefault((t["v1"], t["v2"]), []).append(t)
    weights: dict[str, float] = {}
    for members in classes.values():
        support = {t["in_pages"] for t in members}
        if len(support) == 1 and support.pop() >= 2:
            weights.update({t["path"]: t["text"] for t in members if t["once"] >= STEADY * t["in_pages"]})
    for t in found:
        if t["path"] in steady:
            for path in (t["path"], *above(t["path"])):
                if path in weights:
                    weights[path] -= t["plain"]
    of = {t["path"]: t for t in found}
    paths = sorted(weights)
    return paths, [weigh(weights[p], of[p]["links"]) / of[p]["in_pages"] for p in paths], sorted(steady)


def templates(pages: DataFrame) -> DataFrame:
    """(host, paths, weights, fixed): of every host with two pages or more, the tokens of valid classes and the template's text."""
    fields = [("host", pa.string()), ("path", pa.string()), *((c, pa.int64()) for c in
              ("v1", "v2", "n", "in_pages", "once", "own", "plain", "text", "links", "least", "most"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            sums: dict[tuple[str, str], list[int]] = {}
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                mark = xxhash.xxh3_64_intdigest(page or "")
                for path, t in tokens(page or "").items():
                    said = xxhash.xxh3_64_intdigest("\0".join(t.own)) >> 1
                    own = sum(map(len, t.own))
                    s = sums.setdefault((host, path), [0] * 9 + [said, said])
                    for k, v in enumerate(((mark & 0x7FFFFFFF) * t.n, (mark >> 33) * t.n, t.n, 1, t.n == 1, own, t.plain, t.text, t.links)):
                        s[k] += v
                    s[9], s[10] = min(s[9], said), max(s[10], said)
            columns = list(zip(*((h, p, *s) for (h, p), s in sums.items())))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [f for f, _ in fields])

    schema = ", ".join(f"{name} {'string' if name in ('host', 'path') else 'bigint'}" for name, _ in fields)
    counted = (pages.select("host", "html").filter("host is not null").mapInArrow(run, schema)
               .groupBy("host", "path").agg(*[F.sum(c).alias(c) for c, _ in fields[2:11]], F.min("least").alias("least"), F.max("most").alias("most")))
    host_pages = pages.filter("host is not null").groupBy("host").agg(F.count("*").alias("pages")).filter("pages > 1")
    # more than a tenth of the pages has each: their number is at most ten times a page's
    shared = counted.join(host_pages, "host").filter(f"{LAYOUT} * in_pages > pages")
    token = F.struct("path", "v1", "v2", "in_pages", "once", "own", "plain", "text", "links", F.expr("least = most").alias("same"))
    hosts = shared.groupBy("host").agg(F.collect_list(token).alias("found"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            built = [host_template(found) for found in batch.column("found").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array([b[0] for b in built], pa.list_(pa.string())),
                                              pa.array([b[1] for b in built], pa.list_(pa.float64())),
                                              pa.array([b[2] for b in built], pa.list_(pa.string()))], ["host", "paths", "weights", "fixed"])

    return hosts.mapInArrow(build, "host string, paths array<string>, weights array<double>, fixed array<string>")


def main_text(pages: DataFrame, stages: Stages) -> DataFrame:
    """The rows with ``main_text``. Templates are written first, so the planner knows whether they are small enough to broadcast."""
    kept = pages.drop("main_text")
    hosted = kept.withColumn("_llm_host", F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1)))
    hosted = hosted.withColumn("_llm_host", F.when(F.col("_llm_host") != "", F.col("_llm_host")))
    made = templates(hosted.select(F.col("_llm_host").alias("host"), "html"))
    made = stages.write(made.select(F.col("host").alias("_llm_host"), F.struct("paths", "weights", "fixed").alias("_llm_template")), "templates")
    joined = hosted.join(made, "_llm_host", "left").select(*[F.col(f"`{c}`") for c in kept.columns], "_llm_template")
    names = [*kept.columns, "main_text"]
    at = next(n for n in kept.columns if n.lower() == "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            texts = []
            for page, t in zip(batch.column(at).to_pylist(), batch.column("_llm_template").to_pylist()):
                texts.append(page_text(page, dict(zip(t["paths"], t["weights"])), frozenset(t["fixed"])) if t else page_text(page))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names)

    return joined.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("main_text", T.StringType())]))
