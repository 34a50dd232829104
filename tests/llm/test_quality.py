"""Quality rules against a plain reading of the rules; lines of a host; odd rows."""

import random
import re
from collections import Counter

from tessera.llm import quality
from tessera.llm.quality import COUNTS

SCHEMA = "doc_id long, source string, text string, n_words int, kept string, HOST string"
GAP = r"[^\x20\x09-\x0D]+"


def counts(text):
    text = text or ""
    w = re.findall(GAP, text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(GAP, x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def norm(line):
    return re.sub(r"[\x20\x09\x0B-\x0D]+", " ", line.lower()).strip(" ")


def brute(rows, least, share, left):
    texts, held = {}, {}
    for _, host, text in rows:
        texts.setdefault(host, set()).add(text or "")
    for host, found in texts.items():
        df = Counter(x for t in found for x in {norm(x) for x in t.split("\n")} if x)
        held[host] = {x for x, n in df.items() if n >= least and n >= share * len(found)}
    out = []
    for i, host, text in rows:
        c = counts(text)
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        gone = [x for x in (text or "").split("\n") if norm(x) in held[host]]
        n_left = c[0] - sum(len(re.findall(GAP, x)) for x in gone)
        cleaned = text if text is None else "\n".join(x for x in text.split("\n") if norm(x) not in held[host])
        out.append((i, host, *c, failed, len(gone), n_left, cleaned, not failed and n_left >= 20 and n_left >= left * c[0]))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    rng = random.Random(9)
    boiler = ["All rights  reserved.", "ALL rights\treserved. ", "Sign up for our letter now please"]
    rows = []
    for i in range(150):
        lines = [" ".join(rng.choice(["a", "b", "é", "c#", "<d>", "e\x0bf"]) + str(rng.randint(0, 40)) for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.4:
            lines.insert(rng.randint(0, len(lines)), rng.choice(boiler))
        if rng.random() < 0.3:
            lines += lines[: rng.randint(1, 3)]
        rows.append((i, rng.choice(["x", "y", None]), "\n".join(lines)))
    rows += [(200, "x", None), (201, "y", ""), (202, None, " \n\x0c"), (203, "x", "w " * 30), (None, "z", "only one here"), (5, rows[5][1], rows[5][2])]
    rows += [(300 + i, "x", "All rights reserved.\nsign up for our letter now please\n" + rows[0][2]) for i in range(40)]  # copies count once
    docs = spark.createDataFrame([(i, h, t, 1, "k", "h") for i, h, t in rows], SCHEMA)
    found = quality.quality(docs, least=5, share=0.1, left=0.5)
    got = found.select("doc_id", "host", *COUNTS, "base_failed", "n_lines_removed", "n_words_left", "cleaned", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 5, 0.1, 0.5)


def test_empty_table_and_long_text(spark):
    assert quality.quality(spark.createDataFrame([], SCHEMA)).count() == 0
    text = " ".join(f"w{i}" for i in range(60_000)) + " " + "w " * 20
    row = quality.quality(spark.createDataFrame([(1, "x", text, 1, "k", "h")], SCHEMA)).first()
    assert tuple(row[c] for c in COUNTS) == counts(text) and row.kept
