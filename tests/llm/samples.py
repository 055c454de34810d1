"""Planted documents for the operators' tests."""

import random

TABLES = "/root/testdata/sf0.001"


def words(rng, count):
    return [rng.choice(["la", "de", "étre", "ou", "than", "of", "the", "in"]) + rng.choice(
        ["", "", "eau", "tion", "ing", "ed"]) for _ in range(count)]


def planted(seed=1, documents=60, shared=4):
    """Documents with copies, shared passages at odd places, empty, null and long texts."""
    rng = random.Random(seed)
    passages = [words(rng, rng.randint(50, 90)) for _ in range(shared)]
    rows = []
    for doc_id in range(documents):
        text = words(rng, rng.randint(0, 160))
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(passages)
            cut = rng.randint(0, 20)
            at = rng.randint(0, len(text))
            text[at:at] = passage[cut:]
        rows.append((doc_id * 7 % 101, rng.choice([" ", "\n", "  "]).join(text)))
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, ""), (203, None), (204, "eine"),
             (205, rows[3][1] + " und " + rows[4][1]), (None, rows[0][1]), (206, " \n "),
             (207, rows[5][1]), (207, rows[5][1]), (208, " ".join(words(rng, 6000)))]
    return rows
