"""Synthetic pages in both portals' markup (FIXTURES F2)."""

A_SPAN = "css-s8wpzb eclomwz2"


def a_post(title, spans, location, cls="css-1rtqihe es62z2j18"):
    inner = "".join(f'<span class="{A_SPAN}">{s}</span>' for s in spans)
    return (f'<article class="{cls}"><h3 class="css-1rhznz4 es62z2j13">{title}</h3>{inner}'
            f'<span class="css-17o293g es62z2j11">{location}</span></article>')


def b_post(title, price, location, area=None):
    area_html = f'<p class="css-1bhbxl1-Text eu5v0x0">{area}</p>' if area is not None else ""
    return (f'<div class="css-1apmciz other"><div class="wrap"><h6 class="css-v3vynn-Text eu5v0x0">{title}</h6>'
            f'<p class="css-wpfvmn-Text eu5v0x0">{price}</p></div>'
            f'<p class="css-p6wsjo-Text eu5v0x0">{location}</p>{area_html}</div>')


def page(*posts):
    return "<html><body><main>" + "".join(posts) + "</main></body></html>"


PROMO = [a_post(f"Promo {i}", ["1 000 zł", "1 pokój", "30 m²"], "X, Warszawa") for i in range(3)]

PAGES = [
    # portal A, rent: 3 promoted, then 4/3/2/5 spans, a non-matching article right after a matching one
    ("portal_a", "rent", 0, page(
        *PROMO,
        a_post("Mieszkanie <b>pilne</b> &amp; tanio", ["2 500 zł/mc", "+ czynsz 500 zł", "3 pokoje", "45.5 m²"],
               "Mokotów, Warszawa, mazowieckie"),
        a_post("Kawalerka", ["1 800 zł", "2 pokoje", "38 m²"], "Kraków, Warszawa", cls="css-e6zjf7 es62z2j18")
        + '<article class="css-1rtqihe">Reklama<span class="css-s8wpzb eclomwz2">9 zł</span></article>',
        a_post("Pokój", ["900 zł", "20 m²"], "Nowhere, mazowieckie"),
        a_post("Dom", ["Zapytaj o cenę", "x", "10+ pokoi", "120 m²", "parter"], "Łódź"),
    )),
    # portal A, sell over two pages: the skip of 3 applies once to the category, across pages
    ("portal_a", "sell", 0, page(a_post("S1", ["100 000 zł", "2 pokoje", "50 m²"], "Łódź"),
                               a_post("S2", ["200 000 zł", "3 pokoje", "75 m²"], "Łódź"))),
    ("portal_a", "sell", 1, page(a_post("S3", ["300 000 zł", "4 pokoje", "100 m²"], "Łódź"),
                               a_post("S4 sprzedam pilnie", ["400 000 zł", "5 pokoi", "100.5 m²"], "Łódź"),
                               a_post("S5", ["500 000 zł", "1 pokój", "29.99 m²"], "Łódź"))),
    # portal A, room: a page without posts
    ("portal_a", "room", 0, page("<p>Brak ofert</p>")),
    # portal B: nested divs, missing area, rooms get constant defaults
    ("portal_b", "rent", 2, page(b_post("B1", "1 234,56 zł do negocjacji", "Kraków, Centrum - dzisiaj", "42,5 m²"),
                            b_post("B2", "2 000 zł", "Warszawa - dzisiaj"),
                            b_post("B3 pilnie", "3 000 zł", "Bielsko-Biała, Centrum", "43,5 m²"))),
    ("portal_b", "room", 2, page(b_post("R1", "800 zł", "Gdańsk, Wrzeszcz", "12 m²"))),
]

CITIES = ["Warszawa", "Kraków", "Łódź", "Gdańsk"]
