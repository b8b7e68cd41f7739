from __future__ import annotations

import random
from collections import Counter

from ledgerloom.llm import suffixes


def plain_spans(rows, least):
    texts = [(doc_id, (text or "").encode().split()) for doc_id, text, _ in rows]
    counts = Counter(tuple(words[at : at + least]) for _, words in texts for at in range(len(words) - least + 1))
    out = []
    for doc_id, words in texts:
        span = None
        for at in range(len(words) - least + 1):
            if counts[tuple(words[at : at + least])] > 1:
                if span and at <= span[1]:
                    span[1] = at + least
                else:
                    out += [(doc_id, *span)] if span else []
                    span = [at, at + least]
        out += [(doc_id, *span)] if span else []
    return sorted(out, key=repr)


def spans(docs, **more):
    found = suffixes.repeated_spans(docs, **more).collect()
    assert all(row["n_words"] == row["end_word"] - row["start_word"] for row in found)
    return sorted(((row["doc_id"], row["start_word"], row["end_word"]) for row in found), key=repr)


def sentence(random_, size):
    return [f"w{random_.randrange(4000)}" for _ in range(size)]


def corpus():
    r = random.Random(8)
    passages = [sentence(r, size) for size in (49, 50, 51, 60, 75, 120, 300)]
    rows = []
    for k in range(60):
        words = sentence(r, r.randrange(0, 200))
        for passage in r.sample(passages, r.randrange(3)):
            a = r.randrange(0, len(passage) // 3 + 1)
            b = r.randrange(2 * len(passage) // 3, len(passage) + 1)
            at = r.randrange(len(words) + 1)
            words[at:at] = passage[a:b]
        rows.append((k, " ".join(words), "a"))
    base = sentence(r, 400)
    for k in range(25):  # near copies: any two share stretches of all lengths
        words = list(base)
        for place in r.sample(range(400), r.randrange(1, 9)):
            words[place] = f"changed{k}"
        rows.append((100 + k, "\n".join(words), "b"))
    rows += [(200, "For " * 120, "a"), (201, " ".join(base), "a"), (202, " ".join(base), "c")]
    return rows


def test_spans_equal_brute_force(documents):
    rows = corpus()
    assert spans(documents(rows).repartition(6)) == plain_spans(rows, 50)


def test_other_lengths(documents):
    rows = corpus()
    assert spans(documents(rows), min_words=20, gram=6) == plain_spans(rows, 20)


def test_edges(documents, clashing):
    r = random.Random(9)
    text = " ".join(sentence(r, 70))
    rows = [(None, text, None), (None, text, "a"), (5, text, "a"), (5, text, "a"), (6, None, "a"), (7, "", "a"), (8, "one two", None)]
    assert spans(clashing(documents(rows))) == sorted([(None, 0, 70), (None, 0, 70), (5, 0, 70), (5, 0, 70)], key=repr)
    assert spans(documents([])) == [] and spans(documents(rows[2:3])) == []
