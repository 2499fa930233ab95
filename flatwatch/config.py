"""Per-source settings. Two portals differ only here; a third portal needs a new SourceConfig, not new code."""

from __future__ import annotations

from dataclasses import dataclass, field

from .functions.markup import ClassSpec


@dataclass(frozen=True)
class Selector:
    tag: str
    classes: ClassSpec = None


@dataclass(frozen=True)
class SourceConfig:
    name: str
    container: Selector
    title: Selector
    price: Selector | None
    location: Selector | None
    # Tag and attribute names in any letter case, as HTML has them, or exactly as written.
    case_insensitive_tags: bool = True
    # Several values sharing one class (price, [fee], rooms, area); rooms/area are picked by position.
    spans: Selector | None = None
    area: Selector | None = None
    price_replacements: tuple[tuple[str, str], ...] = ()
    price_sentinels: tuple[str, ...] = ()
    price_full_nfkd: bool = False           # full NFKD of the price text (Arrow UDF) before the replacements
    price_mode: str = "truncate"            # 'truncate' (to whole units) | 'round2'
    city_mode: str = "dictionary"           # 'dictionary' | 'positional'
    area_mode: str = "spans"                # 'spans' (number before space) | 'suffix_half_even'
    has_rooms: bool = True
    skip_leading: int = 0                   # promoted posts to drop per category, over all its pages
    # Categories whose rows get constant defaults: sqm_bucket '0', price_per_sqm 0 and no area/rooms.
    default_types: tuple[str, ...] = ()
    pages: dict[str, tuple[int, int]] = field(default_factory=dict)   # type -> (first, last) page
    required_types: tuple[str, ...] = ("sell",)


# --- fixed values (must stay exactly as written: they select and clean the portals' markup) ------------
PORTAL_A = SourceConfig(
    name="portal_a",
    container=Selector("article", ("css-1rtqihe es62z2j18", "css-e6zjf7 es62z2j18")),
    title=Selector("h3", "css-1rhznz4 es62z2j13"),
    price=Selector("span", "css-s8wpzb eclomwz2"),
    location=Selector("span", "css-17o293g es62z2j11"),
    spans=Selector("span", "css-s8wpzb eclomwz2"),
    price_replacements=((" ", ""), ("zł", ""), ("€", ""), ("$", ""), (",", "."), ("/mc", "")),
    # "ask for price", precomposed and decomposed (NFKD) spelling
    price_sentinels=("Zapytajocen\u0119", "Zapytajocene\u0328"),
    price_mode="truncate",
    city_mode="dictionary",
    area_mode="spans",
    has_rooms=True,
    skip_leading=3,
    pages={"sell": (0, 0), "rent": (0, 0), "room": (0, 0)},
)

PORTAL_B = SourceConfig(
    name="portal_b",
    container=Selector("div", ("css-1apmciz",)),
    title=Selector("h6", "css-v3vynn-Text eu5v0x0"),
    price=Selector("p", "css-wpfvmn-Text eu5v0x0"),
    location=Selector("p", "css-p6wsjo-Text eu5v0x0"),
    area=Selector("p", "css-1bhbxl1-Text eu5v0x0"),
    price_replacements=((" ", ""), ("zł", ""), ("donegocjacji", ""), (",", ".")),
    price_mode="round2",
    city_mode="positional",
    area_mode="suffix_half_even",
    has_rooms=False,
    skip_leading=0,
    default_types=("room",),
    pages={"sell": (2, 2), "rent": (2, 2), "room": (2, 2)},
)
# ------------------------------------------------------------------------------------------------------

SOURCES = (PORTAL_A, PORTAL_B)

# Generic web pages (the driver's `pages` table): list items are the containers, <h1> is the title.
WEB_PAGES = SourceConfig(
    name="web",
    container=Selector("li"),
    title=Selector("a"),
    price=None,
    location=None,
    has_rooms=False,
    skip_leading=3,
)
