from __spark_entry__ import queries
from orderlens.llm import license_scan as ls
from tests.llm.conftest import LONG

MIT, GPL = ls.TEMPLATES[1][1], ls.TEMPLATES[2][1]


def test_own_inherited_and_none(spark):
    rows = [
        ("a/LICENSE", "x\n" + MIT), ("a/b/LICENSE.txt", GPL), ("a/b/c/f.py", "code"), ("a/g.py", None), ("a/bb/h.py", LONG), ("z.py", ""),
        ("a/b/own.py", "# " + MIT + "\r\ncode"), (None, "code"), ("q/f.py", "released under a tree"), ("a/b/c/f.py", "code"), ("COPYING", "nothing here"),
    ]
    df = spark.createDataFrame([(p, t, 1) for p, t in rows], "path string, text string, score int")
    got = {(r.path, r.license, r.found_in, r.origin) for r in ls.scan_licenses(df, keep=("score",)).collect()}
    assert got == {
        ("a/LICENSE", "MIT", "a/LICENSE", "own"), ("a/b/LICENSE.txt", "GPL-3.0", "a/b/LICENSE.txt", "own"),
        ("a/b/c/f.py", "GPL-3.0", "a/b/LICENSE.txt", "inherited"), ("a/g.py", "MIT", "a/LICENSE", "inherited"),
        ("a/bb/h.py", "MIT", "a/LICENSE", "inherited"), ("z.py", None, None, "none"), ("a/b/own.py", "MIT", "a/b/own.py", "own"),
        (None, None, None, "none"), ("q/f.py", None, None, "none"), ("COPYING", None, None, "none"),
    }
    assert ls.scan_licenses(df).count() == len(rows)
    assert ls.scan_licenses(df.limit(0)).collect() == []


def test_a_licence_at_the_root_reaches_all(spark):
    df = spark.createDataFrame([("LICENSE", MIT), ("a/b.py", "x"), ("c.py", "y")], "path string, text string")
    assert {(r.path, r.license) for r in ls.scan_licenses(df).collect()} == {("LICENSE", "MIT"), ("a/b.py", "MIT"), ("c.py", "MIT")}


def test_wrapped_and_embedded_statements(spark):
    rows = {
        "a": "Licensed under the Apache License,\n# Version 2.0.", "b": GPL.replace("GNU General ", "GNU General\r\n * "),
        "c": "Some body text here before it. Released under the MIT License.", "d": "Copyright 2024 Acme. All rights reserved.",
        "e": "Released under the MIT License. and of in", "f": "The software is released under the MIT license", "g": "all the licensed rights",
        "h": "MIT License\n" + LONG, "i": "Released again under the MIT License.",
    }
    more = [(f"x{i}", "and of in again the software is some body text here before it under") for i in range(300)]
    df = spark.createDataFrame([*rows.items(), *more], "path string, text string")
    got = {r.path: (r.license, r.score) for r in ls.scan_texts(df).collect()}
    assert {p: n for p, (n, s) in got.items() if s == 1} == {
        "a": "Apache-2.0", "b": "GPL-3.0", "c": "MIT", "d": "proprietary", "e": "MIT", "f": "MIT",
    }
    assert got["i"][0] == "MIT" and set(got) <= set("abcdefhi")


def test_frequencies_count_every_term_of_all_files(spark):
    texts = ["of of mit", "of", None, "x 2.0\nof", LONG]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r.term: r.files for r in ls._frequencies(df).collect()} == {"": 5, "of": 3, "mit": 1, "x": 1, "2.0": 1, "word": 1}
    # A common foreign word weighs little, one that no other file has much.
    rows = [("a", "released of under the mit license"), ("b", "released zyx under the mit license")] + [(f"f{i}", "of") for i in range(400)]
    got = {r.path: r.score for r in ls.scan_texts(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert 0.98 < got["a"] < 1 and got["b"] < 0.95


def test_the_query_climbs_to_ancestors(spark, sf):
    got = queries()["op2_license_scan"](spark, sf).collect()
    by_path = {r.path: r for r in got}
    assert len(by_path) == len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    heirs = [r for r in got if r.origin == "inherited"]
    for r in heirs:
        giver = by_path[r.found_in]
        folder, above = r.path.rsplit("/", 1)[0], r.found_in.rsplit("/", 1)[0]
        assert giver.origin == "own" and giver.license == r.license and (folder + "/").startswith(above + "/")
    assert any(r.found_in.count("/") < r.path.count("/") for r in heirs)
