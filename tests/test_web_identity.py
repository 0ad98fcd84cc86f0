import random
from html.parser import HTMLParser

import pytest

from tessera.functions.markup import APART, VOID, PageHead
from tessera.operators import identity as A
from tessera.operators import lookup as L
from tessera.operators import web as W

PAGES = "page_id long, url string, html string"


def meta(spark, html):
    return W.page_metadata(spark.createDataFrame([(1, "http://x", html)], PAGES)).first()


def test_title_and_meta_description(spark):
    r = meta(spark, "<html><head><title>  Tide tables  </title>"
                    '<meta name="description" content="High and low water"></head></html>')
    assert (r["title"], r["description"]) == ("Tide tables", "High and low water")


def test_og_fallback(spark):
    r = meta(spark, '<html><head><title>Ferry</title><meta property="og:description" content="Crossing times"></head></html>')
    assert r["description"] == "Crossing times"
    r = meta(spark, '<head><meta name="description" content=""><META PROPERTY="og:description" content="fb"></head>')
    assert (r["title"], r["description"]) == (None, "fb")


def test_title_entities_tags_comments(spark):
    r = meta(spark, "<!-- <title>not me</title> --><script>var s='<title>no</title>';</script>"
                    "<TITLE> Tom &amp; <b> Jerry </b> &#39;s &eacute; </TITLE>"
                    "<meta content='c &amp; d' name=description>")
    assert r["title"] == "Tom &Jerry's é"
    assert r["description"] == "c & d"


def test_first_description_only(spark):
    r = meta(spark, '<meta name="description" content=""><meta name="description" content="later">')
    assert r["description"] is None


def test_attribute_names_are_whole(spark):
    # data-name / data-content are other attributes, not name / content
    r = meta(spark, '<meta data-name="description" content="no"><meta name="description" data-content="no"'
                    ' content="yes">')
    assert r["description"] == "yes"


def test_title_pieces_decoded_then_stripped(spark):
    # an encoded no-break space at a piece's edge is stripped like a plain space
    r = meta(spark, "<title>&nbsp;A&nbsp;<b> B </b>&amp; C</title>")
    assert r["title"] == "AB& C"


@pytest.mark.parametrize("html,title,description", [
    ('<meta name="description" content="a > b">', None, "a > b"),
    ('<meta data-x="a>b" name="description" content="q">', None, "q"),
    ("<meta name=description content=bare>", None, "bare"),
    ('<meta content="<title>no</title>"><title>yes</title>', "yes", None),
    ("<!-- <title>no</title>", None, None),
    ("<p>x<!-- <title>no", None, None),
    ("<title>open <b>x</b> end", "openxend", None),
    ("<head><title>in head</head><body>text", "in head", None),
    ("<title>a<script>b</script>c<!-- d -->e</title>f", "ace", None),
    ("<title/>x<title>second</title>", "", None),
    ('<meta name="description" content="one" content="two">', None, "two"),
    ("<title>1 < 2 &amp;lt; 3</title>", "1 < 2 &lt; 3", None),
    ("<meta name='descri&#112;tion' content='&quot;q&quot;'>", None, '"q"'),
    ("<meta name=Description content=no><title a='>'>t</title >", "t", None),
    (None, None, None), ("", None, None),
])
def test_hard_markup(spark, html, title, description):
    assert PageHead().read(html or "") == (title, description)


class Every(HTMLParser):
    """All tags and texts of a page, from the same parser, read to its end."""

    def __init__(self):
        super().__init__()
        self.events = []

    def handle_starttag(self, tag, attrs):
        self.events.append(("start", tag, dict(attrs)))

    def handle_startendtag(self, tag, attrs):
        self.events += [("start", tag, dict(attrs)), ("end", tag, None)]

    def handle_endtag(self, tag):
        self.events.append(("end", tag, None))

    def handle_data(self, data):
        self.events.append(("text", data, None))

    def handle_comment(self, data):
        self.events.append(("other", data, None))

    handle_decl = handle_pi = unknown_decl = handle_comment


def tree_answer(page):
    """Title and description from the whole tree of the page."""
    parser = Every()
    try:
        parser.feed(page)
        parser.close()
    except AssertionError:
        return None, None
    root = ["", {}, []]
    path, titles, metas = [root], [], []
    for kind, what, attrs in parser.events:
        if kind == "start":
            node = [what, attrs, []]
            path[-1][2].append(node)
            titles += [node] if what == "title" else []
            metas += [node] if what == "meta" and attrs.get("name") == "description" else []
            if what not in VOID:
                path.append(node)
        elif kind == "end":
            if what in [n[0] for n in path[1:]]:
                while path.pop()[0] != what:
                    pass
            path[-1][2].append(["", None, []])  # ends a piece of text, matched or not
        elif kind == "text" and path[-1][2] and isinstance(path[-1][2][-1], str):
            path[-1][2][-1] += what
        else:
            shown = kind == "text" and not any(n[0] in APART for n in path)
            path[-1][2].append(what if shown else ["", None, []])

    def text(node):
        return "".join(c.strip() if isinstance(c, str) else text(c) for c in node[2])

    return text(titles[0]) if titles else None, (metas[0][1].get("content") or "") if metas else None


@pytest.mark.parametrize("seed", range(3))
def test_random_tag_soup_equals_the_parsers_tree(seed):
    rng = random.Random(seed)
    parts = ["<title>", "</title>", "<title ", "<b>", "</b>", "<head>", "</head>", "<meta ", "name=", "content=", '"', "'", ">", "/>", "<", "description", "<!--", "-->", "<script>", "</script>",
             " ", "text", "&amp;", "&#65;", "=", "/", "<meta name=description content=x>", '<meta name="description" content="y > z">', "<br>", "<!x>", "<?p>", "</", "<style>", "</style>", "<rt>", "</rt>"]
    head = PageHead()
    for _ in range(4000):
        page = "".join(rng.choices(parts, k=rng.randint(1, 25)))
        assert head.read(page) == tree_answer(page), page


def test_fetch_outcomes_and_summary(spark):
    f = spark.createDataFrame([(1, "u1", "async", 200, None, 100), (2, "u2", "async", 404, None, 300),
                               (3, "u3", "sequential", None, "Timeout", 1000), (4, "u4", "threaded", 200, None, 400)],
                              "seq long, url string, method string, status_code int, fetch_error string, elapsed_ms long")
    m = spark.createDataFrame([("u1", "T1", "D1"), ("u2", "T2", "D2")], "url string, title string, description string")
    o = {r["seq"]: r for r in W.fetch_outcomes(f, m).collect()}
    assert (o[1]["title"], o[1]["error"]) == ("T1", None)
    assert (o[2]["title"], o[2]["error"]) == (None, "HTTP 404")
    assert (o[3]["status_code"], o[3]["error"], o[3]["fetch_time"]) == (None, "Timeout", 1.0)
    s = {r["method"]: r for r in W.fetch_summary(W.fetch_outcomes(f, m)).collect()}
    assert (s["async"]["total"], s["async"]["successful"], s["async"]["failed"]) == (2, 1, 1)
    c = {r["method"]: r for r in W.method_comparison(W.fetch_summary(W.fetch_outcomes(f, m))).collect()}
    assert c["async"]["is_winner"] and c["sequential"]["speedup"] == 1.0 and c["threaded"]["speedup"] == 2.5


def test_method_tie_prefers_async(spark):
    s = spark.createDataFrame([("sequential", 1.0), ("threaded", 1.0), ("async", 1.0)], "method string, elapsed_sec double")
    win = [r["method"] for r in W.method_comparison(s).collect() if r["is_winner"]]
    assert win == ["async"]


def test_batches(spark):
    items = spark.createDataFrame([(i * 10, f"u{i}") for i in range(10)], "seq long, url string")
    got = W.batch_items(items, size=3, chunk_width=25).orderBy("seq").collect()
    sizes = {}
    for r in got:
        sizes[r["batch_no"]] = sizes.get(r["batch_no"], 0) + 1
    assert sizes == {0: 3, 1: 3, 2: 3, 3: 1}
    assert [r["seq"] for r in W.first_n(items, n=3).collect()] == [0, 10, 20]


ATT = "seq long, email string, password_length long"


def test_registration(spark):
    att = spark.createDataFrame([(1, "a@x", 5), (2, "a@x", 9), (3, "a@x", 12), (4, "b@x", 8), (5, "c@x", 3)], ATT)
    got = [r["outcome"] for r in A.registration_outcomes(att).orderBy("seq").collect()]
    assert got == ["invalid_password", "registered", "already_exists", "registered", "invalid_password"]
    pre = spark.createDataFrame([("b@x",)], "email string")
    got = [r["outcome"] for r in A.registration_outcomes(att, pre).orderBy("seq").collect()]
    assert got[3] == "already_exists"


def test_login(spark):
    users = spark.createDataFrame([("a@x", "h1")], "email string, password_hash string")
    att = spark.createDataFrame([(1, "a@x", "h1"), (2, "a@x", "h2"), (3, "z@x", "h1")],
                                "seq long, email string, credential string")
    assert [r["outcome"] for r in A.login_outcomes(att, users).orderBy("seq").collect()] == [
        "success", "invalid_password", "not_found"]


def test_forecast_lookup(spark):
    req = spark.createDataFrame([(i, c) for i, c in enumerate(["Kigali", "Nairobi", "Addis Ababa", "Dar es Salaam",
                                                                "Paris", "kigali"])], "seq long, city string")
    got = {r["city"]: (r["temperature"], r["description"], r["status"])
           for r in L.forecast_lookup(req, L.forecast_dimension(spark)).collect()}
    assert got["Kigali"] == (25.0, "Sunny", "ok") and got["Dar es Salaam"] == (28.0, "Sunny", "ok")
    assert got["Paris"][2] == "city_not_found" and got["kigali"][2] == "city_not_found"


def test_registration_matches_in_order_model(spark):
    import random

    rnd = random.Random(11)
    emails = ["hot@x"] * 6 + ["a@x", "b@x", "c@x", "d@x"]          # one email takes most attempts
    att = [(s, rnd.choice(emails), rnd.randint(0, 12)) for s in rnd.sample(range(10_000), 80)]
    existing = {"d@x"}
    repo, want = set(existing), {}
    for seq, email, length in sorted(att):
        if email in repo:
            want[seq] = "already_exists"
        elif length < 8:
            want[seq] = "invalid_password"
        else:
            repo.add(email)
            want[seq] = "registered"
    got = A.registration_outcomes(spark.createDataFrame(att, ATT),
                                  spark.createDataFrame([(e,) for e in existing], "email string"))
    assert {r["seq"]: r["outcome"] for r in got.collect()} == want


def test_registered_users_get_the_same_id_each_time(spark):
    import uuid

    a = spark.createDataFrame([(1, "a@x.io", 9), (2, "a@x.io", 9), (3, "b@x.io", 3), (4, "é@x.io", 12)], "seq long, email string, password_length long")
    first, second = ({r.email: r.user_id for r in A.registered_users(A.registration_outcomes(a)).collect()} for _ in range(2))
    assert first == second and set(first) == {"a@x.io", "é@x.io"}
    for i in first.values():
        assert uuid.UUID(i).version == 8 and uuid.UUID(i).variant == uuid.RFC_4122
