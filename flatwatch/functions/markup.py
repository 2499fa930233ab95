"""One scan over markup: tokens, then the elements that selectors ask for as token ranges.

``tokens`` cuts a text into tags, comments, raw-text elements and text, without loss. A tag ends where a parser ends it:
values in quotes may hold ``>`` or whole tags. ``elements`` walks the tags once with a stack of what is open and yields
the range of every matching element; nesting has no limit. Both are built-in JVM expressions; ``scan`` and ``ranges``
are the same two steps on one text within a task, for the extraction of posts, where a walk takes a tenth of the time.
``pieces`` and ``walk`` read a page's posts and their fields at once: tags known from before are not read again
(``page_batch`` does so for many pages).

Rules: an end tag closes the nearest open element of its name and all that is open inside it; one without such an element
is ignored. An element that is still open at the end of the text ends at the first later end tag of its name, if there is
one. Void elements have no inside. ``/>`` closes an element that no selector asks for.
"""

from __future__ import annotations

import bisect
import collections
import functools
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ClassSpec = str | Sequence[str] | None

#: Elements without an end tag (fixed values of HTML).
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

#: Elements whose content is no markup.
RAW = ("script", "style")

_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
ATTRIBUTE = rf"[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE}?+)?+"
_INSIDE = rf"(?:[\s/]++|{ATTRIBUTE})*+"
_MARKUP = r"<(?:" + "|".join([
    *(rf"(?i:{n})(?=[\s/>]){_INSIDE}>.*?</(?i:{n})(?=[\s/>])[^>]*+>" for n in RAW),
    rf"[A-Za-z][^\s/>]*+{_INSIDE}>",
    r"/[A-Za-z][^>]*+>",
    r"!--.*?(?:-->|\z)",
    r"[!?/][^>]*+>"]) + ")"
_TOKEN = rf"(?s)([^<]++|{_MARKUP}?+)"


def let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` evaluated once, however often ``fn`` refers to it (one-element transform)."""
    return F.get(F.transform(F.array(value), fn), 0)


def tokens(html: Column) -> Column:
    """ARRAY<STRING>: the text cut into tags, comments, raw-text elements and text; joined they are the text again."""
    return F.regexp_extract_all(html, F.lit(_TOKEN), 1)


def is_text(token: Column) -> Column:
    return ~token.startswith("<") | (token == "<")


def _class_value(classes: ClassSpec, quote: str) -> str:
    """A class given as one token is one of the attribute's; one with spaces is the whole attribute, spaces aside."""
    out = []
    for c in (classes,) if isinstance(classes, str) else classes:
        words = [re.escape(w) for w in c.split()]
        if len(words) > 1:
            out.append(r"\s*+" + r"\s++".join(words) + r"\s*+")
        else:
            out.append(rf"(?:[^{quote}]*\s)?{words[0]}(?:\s[^{quote}]*)?")
    return "(?:" + "|".join(out) + ")"


def class_regex(classes: ClassSpec, ci: bool = True) -> str:
    """Start tag whose class attribute (the first of that name) has one of the classes."""
    name = "(?i:class)" if ci else "class"
    bare = [re.escape(c) for c in ((classes,) if isinstance(classes, str) else classes) if len(c.split()) == 1]
    forms = [q + _class_value(classes, q) + q for q in "\"'"] + ([rf"(?:{'|'.join(bare)})(?=[\s>])"] if bare else [])
    return rf"(?s)^<[^\s/>]++(?:[\s/]++|(?!{name}[\s=/>]){ATTRIBUTE})*+{name}\s*+=\s*+(?:{'|'.join(forms)})"


def tag_name(tag: Column, ci: bool = True) -> Column:
    name = F.regexp_extract(tag, r"^</?([^\s/>]+)", 1)
    return F.lower(name) if ci else name


def _tags(ts: Column, selectors: Sequence[tuple[str, ClassSpec]], ci: bool) -> Column:
    """ARRAY<STRUCT<at, name, closes, sel>> of the start and end tags; ``sel`` has a bit per matching selector."""
    def matched(token: Column, name: Column) -> Column:
        bits = F.lit(0)
        for i, (tag, classes) in enumerate(selectors):
            fits = name == tag if classes is None else (name == tag) & token.rlike(class_regex(classes, ci))
            bits = bits + F.when(fits, F.lit(1 << i)).otherwise(F.lit(0))
        return F.when(name.isin(*{tag for tag, _ in selectors}), bits).otherwise(F.lit(0))

    def tag(token: Column, at: Column) -> Column:
        closes = token.startswith("</")
        return F.when(~is_text(token) & ~token.startswith("<!") & ~token.startswith("<?"), let(tag_name(token, ci), lambda name: F.struct(
            at.alias("at"), name.alias("name"), F.concat(name, F.lit("/")).alias("key"), closes.alias("closes"),
            F.when(closes, F.lit(0)).otherwise(matched(token, name)).alias("sel"),
            token.endswith("/>").alias("slash"))))

    no_inside = lambda x: x["name"].isin(*VOID, *RAW) | (x["slash"] & (x["sel"] == 0))
    return F.filter(F.transform(ts, tag), lambda x: x.isNotNull() & (x["closes"] | ~no_inside(x)))


def elements(ts: Column, selectors: Sequence[tuple[str, ClassSpec]], ci: bool = True) -> Column:
    """ARRAY<STRUCT<start, end, sel>> of all elements that a selector (name, classes) matches, in document order.

    ``start`` is the number of the start tag among the tokens, ``end`` that of the end tag (or of tokens in all). ``ts``
    must be a column or lambda variable: it is referred to several times.
    """
    selectors = [(tag.lower() if ci else tag, classes) for tag, classes in selectors]
    found_type, open_type = "array<struct<start:int,end:int,sel:int>>", "array<struct<at:int,sel:int,level:int>>"

    def state_of(names: Column, level: Column, open_: Column, found: Column) -> Column:
        return F.struct(names.alias("names"), level.alias("level"), open_.alias("open"), found.alias("found"))

    # ``names`` are those of all open elements, the innermost first, as a path; ``open`` the matching ones among them.
    start = state_of(F.lit(""), F.lit(0), F.array().cast(open_type), F.array().cast(found_type))

    def step(state: Column, tag: Column) -> Column:
        names, level, open_, found = (state[c] for c in ("names", "level", "open", "found"))

        def ended(rest: Column, left: Column) -> Column:
            gone = F.filter(open_, lambda x: x["level"] > left)
            ranges = F.transform(gone, lambda x: F.struct(x["at"].alias("start"), tag["at"].alias("end"), x["sel"].alias("sel")))
            return F.when(F.coalesce(F.get(open_, 0)["level"], F.lit(0)) <= left, state_of(rest, left, open_, found)).otherwise(
                state_of(rest, left, F.filter(open_, lambda x: x["level"] <= left), F.concat(found, ranges)))

        def close(place: Column) -> Column:          # of the nearest open element of the name, in the path
            over = F.substring(names, F.lit(1), place - 1)
            return F.when(place == 0, state).otherwise(ended(
                F.substring(names, place + F.length(tag["key"]), F.length(names)),
                level - 1 - (F.length(over) - F.length(F.replace(over, F.lit("/"), F.lit(""))))))

        opened = state_of(F.concat(tag["key"], names), level + 1, F.when(tag["sel"] == 0, open_).otherwise(F.concat(
            F.array(F.struct(tag["at"].alias("at"), tag["sel"].alias("sel"), (level + 1).alias("level"))), open_)), found)
        innermost = ended(F.substring(names, F.length(tag["key"]) + 1, F.length(names)), level - 1)
        nearest = let(F.instr(F.concat(F.lit("/"), names), F.concat(F.lit("/"), tag["key"])), close)
        return F.when(~tag["closes"], opened).when(names.startswith(tag["key"]), innermost).otherwise(nearest)

    def walk(tags: Column) -> Column:
        def finish(state: Column) -> Column:
            def end(at: Column, name: Column) -> Column:
                later = F.filter(tags, lambda t: t["closes"] & (t["at"] > at) & (t["name"] == name))
                return F.coalesce(F.get(later, 0)["at"], F.size(ts))

            def unclosed(x: Column) -> Column:
                own = F.get(F.filter(tags, lambda t: t["at"] == x["at"]), 0)["name"]
                return F.struct(x["at"].alias("start"), let(own, lambda n: end(x["at"], n)).alias("end"), x["sel"].alias("sel"))

            return F.array_sort(F.concat(state["found"], F.transform(state["open"], unclosed)))

        return F.aggregate(tags, start, step, finish)

    return let(_tags(ts, selectors, ci), walk)


def inside(ts: Column, element: Column) -> Column:
    """The tokens within an element of ``elements``."""
    return F.slice(ts, element["start"] + 2, F.greatest(element["end"] - element["start"] - 1, F.lit(0)))


def inner(ts: Column, element: Column) -> Column:
    """The markup within an element; NULL for a NULL element."""
    return F.when(element.isNotNull(), F.array_join(inside(ts, element), ""))


def of_selector(found: Column, number: int) -> Column:
    """Those elements that the selector of this number matches."""
    return F.filter(found, lambda x: x["sel"].bitwiseAND(F.lit(1 << number)) != 0)


#: Between texts that markup parts: a character reference doesn't reach over it.
SEAM = "\u0000"


def text_pieces(markup: Column) -> Column:
    """The text of markup (a column or lambda variable), with ``SEAM`` where tags stood; ``unescaper`` drops it."""
    return F.when(markup.contains("<"), F.regexp_replace(markup, f"(?s){_MARKUP}", SEAM)).otherwise(markup)


_SCAN = re.compile(_TOKEN.replace(r"\z", r"\Z"), re.ASCII)
_NAME = re.compile(r"</?([^\s/>]+)", re.ASCII)
_MARKUP_SCAN = re.compile(f"(?s){_MARKUP}".replace(r"\z", r"\Z"), re.ASCII)
#: Tags that a task remembers, and the longest of them.
KNOWN_TAGS, KNOWN_CHARS = 4096, 256


def scan(html: str) -> list[str]:
    """``tokens`` of one text."""
    return _SCAN.findall(html)


def without_tags(markup: str) -> str:
    """``text_pieces`` of one text."""
    return _MARKUP_SCAN.sub(SEAM, markup)


def tag_reader(selectors: Sequence[tuple[str, ClassSpec]], ci: bool = True) -> Callable[[str], tuple[str, bool, int] | None]:
    """``fn(token) -> (name, closes, sel)`` as in ``_tags``; None for what is no tag or has no inside."""
    tests = [(tag.lower() if ci else tag, 1 << i, None if classes is None else re.compile(class_regex(classes, ci), re.ASCII))
             for i, (tag, classes) in enumerate(selectors)]

    def read(token: str) -> tuple[str, bool, int] | None:
        if token == "<" or token.startswith(("<!", "<?")):
            return None
        found = _NAME.match(token)
        name = found[1] if found else ""
        name = name.lower() if ci else name
        if token.startswith("</"):
            return name, True, 0
        sel = sum(bit for tag, bit, pattern in tests if tag == name and (pattern is None or pattern.search(token)))
        return None if name in VOID or name in RAW or (sel == 0 and token.endswith("/>")) else (name, False, sel)

    known = functools.lru_cache(KNOWN_TAGS)(read)
    return lambda token: known(token) if len(token) <= KNOWN_CHARS else read(token)


def ranges(ts: Sequence[str], read: Callable[[str], tuple[str, bool, int] | None]) -> list[tuple[int, int, int]]:
    """``elements`` of one text's tokens: (start, end, sel) of the elements that ``read`` (of ``tag_reader``) selects."""
    found, path, depth_of, closed = [], [], {}, {}
    for at, token in enumerate(ts):
        tag = read(token) if token.startswith("<") else None
        if tag is None:
            continue
        name, closes, sel = tag
        if not closes:
            path.append((name, at, sel))
            depth_of[name] = depth_of.get(name, 0) + 1
            continue
        closed.setdefault(name, []).append(at)
        if depth_of.get(name):
            inner_most = None
            while inner_most != name:
                inner_most, start, chosen = path.pop()
                depth_of[inner_most] -= 1
                if chosen:
                    found.append((start, at, chosen))
    for name, start, chosen in path:
        if chosen:
            later = closed.get(name, [])
            place = bisect.bisect_right(later, start)
            found.append((start, later[place] if place < len(later) else len(ts), chosen))
    return sorted(found)


#: Comments and raw-text elements.
HIDDEN = "(?s)<(?:" + "|".join([
    *(rf"[{n[0]}{n[0].upper()}](?i:{n[1:]})(?=[\s/>]){_INSIDE}>.*?</(?i:{n})(?=[\s/>])[^>]*+>" for n in RAW), r"!--.*?(?:-->|\Z)"]) + ")"
#: Where a text is cut first: at these and whatever ends at the first ``>``.
_CUT = re.compile(rf"({HIDDEN}|<[^<>]*+>)".replace("((?s)", "(?s)(", 1), re.ASCII)
#: A start tag that ends at its first ``>``, whatever follows: no quote in it is left open.
_SIMPLE = re.compile(r"""<[A-Za-z][A-Za-z0-9]*(?:\s+[A-Za-z][A-Za-z0-9_:-]*(?:\s*=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>=]+))?)*\s*/?>""", re.ASCII)


class TagTable(dict):
    """Cuts of ``_CUT`` as ``read`` of ``tag_reader`` has them; False for one that may be no token of ``scan``."""

    def __init__(self, selectors: Sequence[tuple[str, ClassSpec]], ci: bool = True) -> None:
        super().__init__()
        self.read = tag_reader(selectors, ci)

    def __missing__(self, tag: str) -> tuple[str, bool, int] | None | bool:
        whole = tag[1] in "!?/" or tag.find("<", 1) > 0 or _SIMPLE.fullmatch(tag)
        known = self.read(tag) if whole else False
        if len(tag) <= KNOWN_CHARS:
            if len(self) >= KNOWN_TAGS:
                self.clear()
            self[tag] = known
        return known


def pieces(html: str, table: TagTable) -> tuple[list[str], list[tuple[str, bool, int] | None]]:
    """The text as [text, tag, text, ..., text], which joined are the text again, and its tags as read."""
    parts = _CUT.split(html)
    tags = list(map(table.__getitem__, parts[1::2]))
    if False not in tags and "<" not in "".join(parts[::2]):
        return parts, tags
    parts, tags, text = [], [], []
    for token in scan(html):
        if token.startswith("<") and token != "<":
            parts += ("".join(text), token)
            tags.append(table.read(token))
            text = []
        else:
            text.append(token)
    return [*parts, "".join(text)], tags


def walk(parts: Sequence[str], tags: Sequence[tuple[str, bool, int] | None], outer: int) -> list[tuple[int, int, int]] | None:
    """(start, end, sel), as numbers of tags, of the elements that are selected, in document order.

    They are those of ``ranges``, over the whole text and over each ``outer`` element (bits of ``sel``) alone. For the rare
    markup where the two differ it is None: a selected element that is never closed, one that ends only with an outer
    element around it, and one that is closed by ``/>``.
    """
    found, names, marks, depth_of = [], [], [], None
    for at, tag in enumerate(tags):
        if tag is None:
            continue
        name, closes, sel = tag
        if not closes:
            if sel and parts[2 * at + 1].endswith("/>"):
                return None
            names.append(name)
            marks.append((at, sel))
            if depth_of is not None:
                depth_of[name] += 1
        elif names and names[-1] == name:
            names.pop()
            start, sel = marks.pop()
            if sel:
                found.append((start, at, sel))
            if depth_of is not None:
                depth_of[name] -= 1
        else:
            if depth_of is None:
                depth_of = collections.Counter(names)
            if not depth_of[name]:
                continue
            selected = False
            inner_most = None
            while inner_most != name:
                inner_most = names.pop()
                depth_of[inner_most] -= 1
                start, sel = marks.pop()
                if sel:
                    if selected and sel & outer:
                        return None
                    selected = True
                    found.append((start, at, sel))
    if any(sel for _, sel in marks):
        return None
    found.sort()
    return found
