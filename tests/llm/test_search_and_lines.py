"""Nearest neighbours, line dedup, licences."""

import numpy as np

from llm_fixtures import frame  # noqa: F401
from wireglass.llm import licenses, line_dedup, neighbours

VECTORS = "vec_id long, embedding array<float>, label int"


def test_neighbours_recall_and_order(frame):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 32)).astype(np.float32)
    x[700:720] = x[100]
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    odd = [(2000, None, 0), (2100, [0.0] * 32, 0), (2200, [float("nan")] * 32, 0), (2300, [1.0, None] * 16, 0), (2400, [1.0] * 8, 0), (2500, [float("inf")] * 32, 0)]
    table = frame(rows + odd, VECTORS).repartition(3)
    got = neighbours.search(table, table.where("vec_id % 100 = 0")).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    assert set(by) == {k for k in range(0, 1500, 100)}
    ids, doubles, hits = np.arange(1500), x.astype(np.float64), 0
    for q, found in by.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        assert [(r["score"], r["vec_id"]) for r in found] == sorted((r["score"], r["vec_id"]) for r in found)
        for r in found:
            assert r["score"] == np.sqrt(((doubles[r["vec_id"]] - doubles[q]) ** 2).sum())
        best, _ = neighbours.brute_force(ids, doubles, q, doubles[q])
        hits += len(set(best) & {r["vec_id"] for r in found})
    assert hits / (10 * len(by)) >= 0.9
    assert [r["vec_id"] for r in sorted(by[100], key=lambda r: r["rank"])] == list(range(700, 710))


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 32))
    codes = neighbours.learn(x)
    index = neighbours.Index(np.arange(3000), x, codes)
    for radius in (0, 3, 7, 11, 16):
        want = np.flatnonzero(neighbours.ONES[index.bits ^ index.bits[5]].sum(axis=1) <= radius)
        assert np.array_equal(index.within(index.bits[5], radius), want)


def test_few_and_no_candidates(frame):
    few = frame([(0, [1.0] * 8, 1), (1, [2.0] * 8, 1), (0, [3.0] * 8, 1)], VECTORS)
    got = neighbours.search(few, few.where("vec_id = 1")).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(1, 1, 0), (1, 2, 0)]
    assert neighbours.search(few.limit(0), few.limit(0)).count() == 0
    assert neighbours.search(few, few.where("vec_id = 77")).count() == 0


def test_query_blocks_give_the_same(frame, monkeypatch):
    rng = np.random.default_rng(3)
    table = frame([(k, rng.normal(size=16).tolist(), 0) for k in range(400)], VECTORS)
    queries = table.where("vec_id % 20 = 0")
    want = sorted(map(tuple, neighbours.search(table, queries).collect()))
    monkeypatch.setattr(neighbours, "QUERIES", 3)
    assert sorted(map(tuple, neighbours.search(table, queries).collect())) == want


def test_lines_of_many_sites_go(frame):
    rows = []
    for k in range(40):
        text = [f"own line {k}", "", "  everywhere  ", "nine sites" if k < 9 else "other", "ten sites" if k < 10 else f"x{k}"]
        rows.append((k, "\n".join(text), f"s{k}" if k else None, "hash"))
    # one site with a third of all rows does not spread a line
    rows += [(100 + k, "hot line\n\n", "s1", "x") for k in range(20)]
    rows += [(200, None, "s1", "x"), (201, "", "s2", "x"), (1, "ten sites", "s1", "x"), (1, "ten sites", "s1", "x")]
    docs = frame(rows, "doc_id long, text string, source string, hash string").repartition(3)
    got = line_dedup.remove(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[2]["text"] == "own line 2\n\nnine sites" and (by[2]["n_lines"], by[2]["n_removed"]) == (4, 2)
    # "other" is shown by 31 sites
    assert by[30]["text"] == "own line 30\n\nx30"
    assert by[100]["text"] == "hot line\n\n" and by[200]["text"] is None and by[201]["text"] == ""
    assert sum(r["doc_id"] == 1 and r["text"] == "" for r in got) == 2
    assert line_dedup.remove(docs.limit(0)).count() == 0


def test_near_lines_are_counted_exactly(frame):
    """With more sites than small sketches tell apart, the threshold still holds exactly."""
    least = 300
    rows = [(s * 10 + k, f"line {k}", f"s{s}") for k in range(6) for s in range(least - 3 + k)]
    docs = frame(rows, "doc_id long, text string, source string")
    found = line_dedup.spread_lines(docs, least).count()
    assert found == 3


def test_licences(frame):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 500)
    rows = [
        (1, "Some text.\nReleased under the MIT License.\nMore text."),
        (2, "Copyright (c) 2020 Somebody\n\n" + mit.replace(". ", ".\n").lower()),
        (3, "Nothing here " * 20),
        (4, None),
        (5, ""),
        (6, "Licensed under CC BY-NC 4.0.\nAll rights reserved."),
        (7, "words " * 100_000),
    ]
    got = {r["doc_id"]: r for r in licenses.scan(frame(rows, "doc_id long, text string")).collect()}
    assert got[1]["license"] == "MIT" and got[1]["dice"] == 1.0
    assert got[2]["license"] == "MIT" and got[2]["dice"] > 0.9
    assert all(got[k]["license"] is None and got[k]["dice"] == 0 for k in (3, 4, 5, 7))
    assert got[6]["licenses"] == ["CC-BY-NC-4.0", "proprietary"] and got[6]["n_passages"] == 3


def test_size_bounds_lose_no_template():
    matcher = licenses.Matcher()
    for _, text in licenses.TEMPLATES:
        words = licenses.normalised(text)
        for change in (words, words[:-1], [*words, "more"]):
            bag, best = licenses.bigrams(change), 0
            for other in matcher.bags:
                best = max(best, 2 * sum((bag & other).values()) / (sum(bag.values()) + sum(other.values())))
            found = matcher.match(change)
            assert (found[1] if found else 0) == (best if best >= licenses.LEAST - 1e-12 else 0)


def test_what_follows_a_copyright_statement(frame):
    texts = {
        "Copyright (c) 2024 Acme Ltd. All rights reserved.": ["proprietary"],
        "Copyright 2024 Acme Ltd, All Rights Reserved": ["proprietary"],
        "  © 2024 Acme. Licensed under CC BY 4.0.": ["CC-BY-4.0"],
        "Copyright © 2019 - 2024 J. R. Smith | Licensed under CC BY-SA 4.0.": ["CC-BY-SA-4.0"],
        "(c) 2024 Acme - Released under the MIT License.": ["MIT"],
        "Copyright (c) 2024 J. R. Smith and others": [],
        "Copyright (c) 2024 Acme Inc.": [],
    }
    assert {t: sorted({n for n, _ in licenses.Matcher().scan(t)}) for t in texts} == texts
    got = licenses.scan(frame([(1, next(iter(texts)))], "doc_id long, text string")).first()
    assert (got["license"], got["dice"], got["n_passages"]) == ("proprietary", 1.0, 1)
    # a wrapped line of a licence is no statement
    assert licenses.normalised("the above\ncopyright notice and\nCOPYRIGHT HOLDERS BE") == "the above copyright notice and copyright holders be".split()


def test_notices_inside_long_texts(frame):
    """Notices of several paragraphs, and inside lines, wherever they stand."""
    long = {n: t for n, t in licenses.TEMPLATES if len(t) > 500}
    prose = "\n\n".join(f"Chapter {k}. The house by the river, and the software of the year, are described in part {k}." for k in range(400))

    def parted(text, *ends):
        for end in ends:
            assert end in text
            text = text.replace(end, end + "\n\n")
        return text

    mit = parted(long["MIT"], "following conditions:", "portions of the Software.")
    bsd = parted(long["BSD-3-Clause"], "are met:", "this list of conditions and the following disclaimer. ", "distribution. ", "permission. ")
    gpl = parted(long["GPL-3.0-or-later"], "any later version.", "for more details.")
    rows = [
        (1, f"{prose}\n\nMIT License\n\nCopyright (c) 2024 Somebody\n\n{mit}\n\n{prose}"),
        (2, f"{prose}\n\n{bsd}\n\n{prose}"),
        (3, f"{prose}\n\n{gpl}\n\n{prose}"),
        (4, "This is a book. Released under the MIT License. More prose follows here, and more."),
        (5, "The tool, which is licensed under CC BY 4.0, was written in a winter and is used by few people in the city."),
        (6, f"{prose}\n\n{mit}\n\n{prose}\n\n{bsd}\n\n{mit}\n\n{prose}"),
        (7, prose),
        (8, f"{prose} {mit.replace('any person', 'any good person of the town').replace('without limitation', 'with no limits')} {prose}"),
    ]
    got = {r["doc_id"]: r for r in licenses.scan(frame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["licenses"], got[1]["dice"], got[1]["n_passages"]) == (["MIT"], 1.0, 2)
    assert (got[2]["licenses"], got[2]["dice"], got[2]["n_passages"]) == (["BSD-3-Clause"], 1.0, 1)
    assert (got[3]["licenses"], got[3]["dice"], got[3]["n_passages"]) == (["GPL-3.0-or-later"], 1.0, 1)
    assert (got[4]["licenses"], got[5]["licenses"]) == (["MIT"], ["CC-BY-4.0"])
    assert (got[6]["licenses"], got[6]["n_passages"]) == (["BSD-3-Clause", "MIT"], 3)
    assert got[7]["license"] is None and got[8]["license"] == "MIT" and 0.9 < got[8]["dice"] < 1
