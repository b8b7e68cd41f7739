from __future__ import annotations

import random

from ledgerloom.llm import line_dedup, queries

BOILER = "This line stands on a great many sites."
COPY = "\n".join(f"Sentence number {k} of a copied document." for k in range(6))


def plain_clean(rows, min_sites=8):
    """(doc_id, text, removed lines) of every row."""
    voices = {}
    for _, text, source in rows:
        if text is not None:
            known = source is not None, source  # a null site only where all are null
            voices[text] = min(voices.get(text, known), known, key=lambda one: (not one[0], one[1] or ""))
    sites = {}
    for text, site in voices.items():
        for line in text.split("\n"):
            sites.setdefault(line.strip(" \t\r"), set()).add(site)
    out = []
    for doc_id, text, _ in rows:
        spread = []
        if text is not None:
            lines = text.split("\n")
            spread = [bool(line.strip(" \t\r")) and len(sites[line.strip(" \t\r")]) >= min_sites for line in lines]
            text = "\n".join(line for line, gone in zip(lines, spread) if not gone)
        out.append((doc_id, text, sum(spread)))
    return sorted(out, key=repr)


def cleaned(docs):
    rows = line_dedup.cleaned(docs).select("row.doc_id", "row.text", "removed_lines")
    return sorted(map(tuple, rows.collect()), key=repr)


def corpus():
    random.seed(4)
    rows = []
    for k in range(60):
        lines = [f"Own line {k}-{j} with some words in it." for j in range(4)]
        if k % 2:
            lines.insert(random.randrange(5), BOILER + random.choice(["", " ", "\r"]))
        if k % 3 == 0:
            lines.append("Short one.")
        rows.append((k, "\n".join(lines), f"s{k % 11}"))
    rows += [(100 + k, COPY, f"s{k}") for k in range(12)]  # a document copied to every site
    rows += [(200 + k, f"Only on few sites, this line is.\n{'x' * 80} {k}", f"s{k % 7}") for k in range(20)]
    rows += [(300 + k, f"Just on eight sites, this line is.\n{'y' * 80} {k}", f"s{k % 8}") for k in range(20)]
    return rows


def test_lines_equal_brute_force(documents):
    rows = corpus()
    found = cleaned(documents(rows))
    assert found == plain_clean(rows)
    removed = {doc_id: n for doc_id, _, n in found}
    assert all(removed[k] == (k % 2 == 1) + (k % 3 == 0) for k in range(60))  # short lines go like long ones
    assert all(removed[k] == 0 for k in range(100, 112))  # a copied document stays


def test_texts_that_are_mostly_spread_lines_lose_them(documents):
    menu = ["Home", "About us", "All rights reserved."]
    rows = [(k, "\n".join([*menu, f"own {k}"]), f"s{k}") for k in range(9)] + [(50, "\n".join(menu), "s0"), (51, "Home", "s1")]
    found = {doc_id: text for doc_id, text, _ in cleaned(documents(rows))}
    assert found == {**{k: f"own {k}" for k in range(9)}, 50: "", 51: ""}


def test_far_above_the_threshold_no_exact_count_is_needed(documents):
    rows = [(k, f"{BOILER}\n{'z' * 60} {k}", f"site {k}") for k in range(40)]
    found = line_dedup.clean(documents(rows)).collect()
    assert all(BOILER not in row["text"] for row in found) and len(found) == 40


def test_edges(documents, clashing):
    long = "\n".join([BOILER, *[f"line {k} of a very long text" for k in range(60_000)]])
    rows = corpus() + [(None, None, None), (None, "", "s1"), (1, "\n\n", None), (1, "\n\n", None), (7000, long, "s3")]
    docs = clashing(documents(rows)).selectExpr("*", "7 as removed_lines", "'x' as places2", "1 as text_a", "2 as line_a", "3 as site")
    found = line_dedup.clean(docs)
    assert found.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=repr) == sorted(((i, t) for i, t, _ in plain_clean(rows)), key=repr)
    assert {r["removed_lines"] for r in found.collect()} == {7}
    assert line_dedup.clean(documents([])).count() == 0


def test_null_sites_are_one_site(documents):
    rows = [(k, f"{BOILER}\n{'z' * 60} {k}", f"s{k}" if k < 7 else None) for k in range(12)]
    assert all(BOILER not in row["text"] for row in line_dedup.clean(documents(rows)).collect())
    assert all(BOILER in row["text"] for row in line_dedup.clean(documents(rows[1:])).collect())


def test_every_copy_speaks_for_its_site(spark, documents, tmp_path):
    """Texts that all lie on one first site too: the line they share stands on all their sites, not on that one alone."""
    rows = [(10 * k + j, f"{BOILER}\nown words of text {k}", site) for k in range(4) for j, site in enumerate(["s0", f"s{2 * k + 1}", f"s{2 * k + 2}"])]
    rows += [(100 + k, "One text,\ncopied to many sites.", f"s{k}") for k in range(12)]

    def queried(rows, name):
        documents(rows).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        return {r["doc_id"]: (r["text"], r["removed_lines"]) for r in queries.op4_line_dedup(spark, f"{tmp_path}/{name}").collect()}

    found = queried(rows, "all")
    assert all(found[10 * k + j] == (f"own words of text {k}", 1) for k in range(4) for j in range(3))
    assert all(found[100 + k] == ("One text,\ncopied to many sites.", 0) for k in range(12))
    assert all(removed == 0 for _, removed in queried(rows[:9], "few").values())  # s0 to s6


def test_every_copy_equals_brute_force_without_copies_of_shared_lines(documents):
    rows = corpus()
    found = line_dedup.cleaned(documents(rows), every_copy=True).select("row.doc_id", "row.text", "removed_lines")
    assert sorted(map(tuple, found.collect()), key=repr) == plain_clean(rows)
