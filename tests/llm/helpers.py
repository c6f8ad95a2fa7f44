"""Small tables for the corpus operators."""

import re

LOWER = {i: i + 32 for i in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return (text or "").translate(LOWER)


def documents(spark, rows):
    """(doc_id, text) with further columns whose names the operators use inside."""
    shape = "doc_id long, text string, id string, n long, label string, words string, size int, shard int, places int"
    return spark.createDataFrame([(i, t, "x", 1, "y", "z", 2, 3, 4) for i, t in rows], shape)


def components(nodes, links):
    """Least node reachable, by brute force."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}
