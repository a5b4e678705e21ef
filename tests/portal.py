"""A garden handbook as a portal of our own.

A menu shows some pages; links, or nothing but a name, tell of others. Two pages link to each other, a redirect takes
two hops, two files have one name, one page is missing and one is plumbing. Each page has a frame that has to go and
passages that a browser hides and that have to stay.
"""

from docgraph.functions.ids import Space

SPACE = Space("Field/Garden", "https://docs.example.org", ("old.example.com",))
S = SPACE.dotted
#: page below the space: title, the page whose menu entry it stands under (None: not in the menu)
PAGES = {
    "": ("Garden book", None),
    "Soil": ("Soil", ""),
    "Soil.Compost": ("Compost", "Soil"),
    "Soil.Compost.Bins": ("Compost bins", "Soil.Compost"),
    "Soil.Heap": ("Heap", "Soil"),
    "Soil.Pile": ("Pile", None),
    "Soil.Mulch": ("Mulch", None),
    "Soil.Mulch.Bark": ("Bark", None),
    "Plants": ("Plants", ""),
    "Plants.Beans": ("Beans", "Plants"),
    "Plants.Beans.Runner": ("Runner beans", "Plants.Beans"),
    "Plants.Peas": ("Peas", "Plants"),
    "Plants.SeedClass": ("Seed class", None),
}
MOVED = {"Soil.Heap": "Soil.Pile", "Soil.Pile": "Soil.Compost"}
LINKS = {
    "Soil.Compost": {
        "mulch": "/bin/Field/Garden/Soil/Mulch/", "bins, from here": "Bins", "sowing": "https://docs.example.org/bin/Field/Garden/Plants/Beans/#sow",
        "an old address": "https://old.example.com/xwiki/bin/view/Field/Garden/Plants", "behind a login": "/bin/login/A/B?xredirect=%2Fbin%2FField%2FGarden%2FPlants%2F",
        "worms": "/bin/Field/Garden/Soil/Worms/", "the heap": "/bin/Field/Garden/Soil/Heap/", "up": "#start", "gone": "#gone",
        "plan": "/bin/download/Field/Garden/Soil/Compost/plan.pdf", "elsewhere": "https://example.com/worms", "plumbing": "/bin/Field/Garden/Plants/SeedClass/",
    },
    "Soil.Mulch": {"bark": "/bin/Field/Garden/Soil/Mulch/Bark/"},
    "Plants.Beans": {"peas": "/bin/Field/Garden/Plants/Peas/", "plan": "/bin/download/Field/Garden/Plants/Beans/plan.pdf"},
    "Plants.Peas": {"beans": "/bin/Field/Garden/Plants/Beans/"},
}
FRAME = ("main-navigation", "leftColumn", "document-footer")
VEILED = {
    "styled": '<p style="visibility: hidden; color: red">{}</p>',
    "folded": '<div class="collapse">{}</div>',
    "unread": '<p aria-hidden="true">{}</p>',
    "closed": "<details><summary>more</summary>{}</details>",
    "cell": "<table><tr><th>what<th>when<tr><td>{}<td>May</table><table><tr><td>one</table>",
}


def tag(name: str, inner: str, **attrs: str) -> str:
    return f"<{name}{''.join(f' {k.rstrip('_')}="{v}"' for k, v in attrs.items())}>{inner}</{name}>"


def address(doc: str) -> str:
    return "/".join([SPACE.base + "/bin", SPACE.path, *filter(None, doc.split(".")), ""])


def listed(under: str) -> str:
    below = [tag("li", tag("a", title, href=address(doc)) + listed(doc)) for doc, (title, parent) in PAGES.items() if parent == under]
    return tag("ul", "".join(below)) if below else ""


def sentence(doc: str, kind: str) -> str:
    """The passage of a page that is hidden, or framed, in this way."""
    return f"{PAGES[doc][0]} {kind} words."


def html(doc: str) -> str:
    if doc in MOVED:
        return tag("body", tag("div", tag("div", "See " + tag("a", "here", href=address(MOVED[doc])), class_="redirect"), id="xwikicontent"))
    title = PAGES[doc][0]
    frame = [tag("div", sentence(doc, x) + (tag("div", listed(""), class_="sidebar") if x == "leftColumn" else ""), id=x) for x in FRAME]
    seasons = {"spring": "Spring", "summer": "Summer", "winter": "Winter"}
    tabs = tag("ul", "".join(tag("li", tag("a", x, href=f"#{k}")) for k, x in seasons.items()), class_="nav-tabs")
    panes = "".join(tag("div", sentence(doc, k), id=k, class_="tab-pane hide", style="display:none") for k in seasons)
    body = [tag("h1", title, id="contentTitle"), f'<p id="start">About {title} &amp; more<p>and<br>on', tag("div", tabs + tag("div", panes, class_="tab-content"), class_="tabbable")]
    body += [shape.format(sentence(doc, kind)) for kind, shape in VEILED.items()]
    body += ['<img src="/img/spade.png?w=3"><img data-src="/img/late.png"><img src="/img/rake.png"><div data-src="https://video.example.com/dig">play</div><script>"</p>never shown"</script><a>bare</a>']
    body += [tag("a", text, href=href) for text, href in LINKS.get(doc, {}).items()]
    return tag("html", tag("head", "<style>p{}</style>") + tag("body", frame[0] + frame[1] + tag("div", " ".join(body), id="xwikicontent") + frame[2]))


def rows() -> list[tuple]:
    return [(f"{S}.{doc}" if doc else S, 200, html(doc)) for doc in PAGES]


def pages(spark):
    return spark.createDataFrame(rows(), "doc string, status int, html string")
