import pytest

import sparsepages as sp

CASES = [
    ("/", ("Default", "Home", "Index", None)),
    ("", ("Default", "Home", "Index", None)),
    ("https://h.example", ("Default", "Home", "Index", None)),
    ("https://h.example?x=/a/b", ("Default", "Home", "Index", None)),
    ("/comics/5", ("Comic", "comic", "Index", "5")),
    ("/comics/5/", ("Comic", "comic", "Index", "5")),
    ("/COMICS/5", ("Comic", "comic", "Index", "5")),
    ("/comics", ("Comic", "comic", "Index", None)),
    ("http://h.example:8080/comics/7?q=1#f", ("Comic", "comic", "Index", "7")),
    ("/comics/5/6", ("Default", "comics", "5", "6")),
    ("/Comic/Index/5", ("Default", "Comic", "Index", "5")),
    ("/a", ("Default", "a", "Index", None)),
    ("/a/b", ("Default", "a", "b", None)),
    ("/x.axd/y", ("ignored", None, None, None)),
    ("/x.axd", ("ignored", None, None, None)),
    ("/x.axd/y/z/w/v", ("ignored", None, None, None)),
    ("/a/x.axd", ("Default", "a", "x.axd", None)),
    ("/a/b/c/d", (None, None, None, None)),
    ("/a//b", (None, None, None, None)),
    ("/a//", (None, None, None, None)),
    ("//", (None, None, None, None)),
    ("/a/b/c/", ("Default", "a", "b", "c")),
    ("/comics//", (None, None, None, None)),
    ("/.axd", ("Default", ".axd", "Index", None)),
    ("/x.AXD/", ("ignored", None, None, None)),
    ("/x.axdy", ("Default", "x.axdy", "Index", None)),
    ("/a%20b/c+d", ("Default", "a b", "c+d", None)),
    ("/a%2/b", ("Default", "a%2", "b", None)),
    (None, (None, None, None, None)),
]


@pytest.fixture(scope="module")
def routed(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, url string")
    return {r["i"]: tuple(r)[2:] for r in sp.classify_routes(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[repr(c[0]) for c in CASES])
def test_route(routed, i):
    assert routed[i] == CASES[i][1]


def test_own_routes_in_order(spark):
    routes = [
        sp.Route("File", "files/{name}.{ext}", {}),
        sp.Route("Tail", "files/{*rest}", {}),
    ]
    df = spark.createDataFrame([("/files/a.txt",), ("/files/a/b",), ("/files",), ("/other",)], "url string")
    out = sp.classify_routes(df, routes=routes, outputs=["name", "ext", "rest"]).collect()
    assert [tuple(r)[1:] for r in out] == [
        ("File", "a", "txt", None),
        ("Tail", None, None, "a/b"),
        ("Tail", None, None, None),
        (None, None, None, None),
    ]
