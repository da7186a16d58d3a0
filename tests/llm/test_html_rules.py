"""The two-pass block rules: against a brute-force labelling of the written rules, and on the pages of the tables without their article tags."""

import collections
import html
import random
import re

import pytest
from quadrille.llm import html_text as H

SF = "/root/testdata/sf0.01"
LONG = "This is the first part of the article, and it is long enough to be judged by the rules, as it has the words of the language that they look for. "


def article_of(page):
    inner = re.search("<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inner))).split())


@pytest.mark.parametrize("tag", ["", "div"])
def test_pages_of_the_tables_without_article_tags(spark, tag):
    """The rules find the text without the markup, too."""
    right = hit = mine = theirs = 0
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect()]
    for page in pages:
        bare = re.sub(r"<(/?)(?:article|main)\b[^>]*>", rf"<\1{tag}>" if tag else "", page)
        assert not re.search("<(?:article|main)", bare)
        found, expected = H.extract(bare).split(), article_of(page).split()
        right += found == expected
        hit += sum((collections.Counter(found) & collections.Counter(expected)).values())
        mine, theirs = mine + len(found), theirs + len(expected)
    assert hit >= 0.99 * mine and hit >= 0.99 * theirs and right >= 0.97 * len(pages)


# A page is a list of sections (element, blocks); a block is (tag, text, linked text).


def random_page(rnd):
    def text():
        stops, n = rnd.choice([0, 0.1, 0.2, 0.5, 0.9]), rnd.choice([1, 4, 9, 14, 30, 60])
        return " ".join("the" if rnd.random() < stops else rnd.choice(["quorz", "blimnek", "vashtuul"]) for _ in range(n))

    def block():
        linked = text() if rnd.random() < 0.25 else ""
        return rnd.choice(["p", "p", "p", "h2"]), text(), linked

    return [(rnd.choice(["div", "div", "div", "nav", "footer", "article"]), [block() for _ in range(rnd.randint(1, 6))]) for _ in range(rnd.randint(1, 5))]


def markup(page):
    one = lambda tag, text, linked: f"<{tag}>{text}" + (f" <a href=x>{linked}</a>" if linked else "") + f"</{tag}>"
    return "<body>" + "".join(f"<{e}>{''.join(one(*b) for b in blocks)}</{e}>" for e, blocks in page) + "</body>"


def labelled(page):
    """The written rules, step by step; the text of the page."""
    rows = []
    for section, (element, blocks) in enumerate(page):
        for tag, text, linked in blocks:
            whole = f"{text} {linked}".strip()
            words = whole.split()
            rows.append({"section": section, "marked": element in ("nav", "footer"), "inside": element == "article", "head": tag == "h2", "text": whole, "length": len(whole), "linked": len(linked), "stops": words.count("the") / len(words), "label": None})
    free = [r for r in rows if not r["marked"]]
    for r in free:
        limit = 0.5 if r["inside"] else 0.2
        if r["linked"] > limit * r["length"]:
            r["label"] = None if r["inside"] and r["head"] else "not"
        elif r["length"] >= 70 and (r["stops"] >= 0.3 or (r["length"] > 200 and r["stops"] >= 0.15)):
            r["label"] = "text"
    of_rule_3 = [r for r in free if r["label"] == "text"]
    for r in free:
        if r["label"] is None and not r["inside"] and r["length"] > 200 and not any(x["section"] == r["section"] for x in of_rule_3):
            r["late"] = "not" if of_rule_3 else "text"
    for r in free:
        r["label"] = r.get("late", r["label"])
    plain = lambda x: x["length"] - x["linked"]
    own = sum(plain(r) for r in free if r["inside"] and r["label"] != "not")
    if own and own >= sum(plain(r) for r in free if not r["inside"] and r["label"] == "text"):
        for r in free:
            if not r["inside"] and not (r["length"] > 200 and r["stops"] >= 0.3):
                r["label"] = "not"
    final = []
    for k, r in enumerate(rows):
        if r["marked"]:
            continue
        label = r["label"]
        if label is None:
            near = [(abs(j - k), j, x) for j, x in enumerate(rows) if x["label"] and x["inside"] == r["inside"]]
            near = [n for n in near if n[2]["section"] == r["section"]] or near
            before, after = min((n for n in near if n[1] < k), default=None, key=lambda n: n[0]), min((n for n in near if n[1] > k), default=None, key=lambda n: n[0])
            if not near:
                label = "text" if r["inside"] or not any(x["inside"] for x in free) else "not"
            elif after and (r["head"] or not before):
                label = after[2]["label"]
            elif not after:
                label = before[2]["label"]
            elif before[0] == after[0]:
                label = "text" if before[2]["label"] == after[2]["label"] == "text" else "not"
            else:
                label = min(before, after)[2]["label"]
        if label == "text":
            final.append(r["text"])
    return " ".join(final)


def test_rules_against_brute_force():
    rnd, texts = random.Random(29), 0
    for _ in range(3000):
        page = random_page(rnd)
        # what wraps the page or holds the larger part of it is another rule: menus and footers here never do
        expected = labelled(page)
        assert H.extract(markup(page)) == expected, markup(page)
        texts += bool(expected)
    assert texts > 1000


@pytest.mark.parametrize(
    ("value", "marks"),
    [
        ("site-footer", {"footer"}), ("siteFooter", {"footer"}), ("no-sidebar", set()), ("layout no-sidebar", set()), ("has-sidebar", set()), ("sidebar-left", {"sidebar"}), ("sidebar", {"sidebar"}),
        ("menu-bar nav", {"menu", "nav"}), ("shared", set()), ("share-price-story", set()), ("header-image-story", set()), ("post adverts", {"adverts"}), ("upload_form", {"form"}), ("", set()),
    ],
)
def test_marks_are_whole_tokens_or_their_last_part(value, marks):
    assert H.marks_of(value) == marks


@pytest.mark.parametrize("attribute", ["data-id=share", 'data-role="menu"', "data-class='ad'", "aria-role=nav", "class='layout no-sidebar'", "class='share-price-story'", "id=adaptive", "title='class=ad'"])
def test_wrappers_without_marks(attribute):
    assert H.extract(f"<body><div {attribute}><p>{LONG}</p><p>Short</p></div><div class=ad><p>{LONG}</p></div></body>") == f"{LONG}Short"


def test_neighbours_across_unclosed_inline_elements():
    assert H.extract(f"<body><p><b>One two<br><p>{LONG}</p><p>Short</p><footer>{LONG}</footer>") == f"One two {LONG}Short"
    assert H.extract(f"<body><p>{LONG}<p><a href=1>{LONG}<p>{LONG}</a></body>") == LONG.strip()
