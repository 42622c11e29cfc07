"""Plain restatements of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows, extra=False):
    """Rows of (doc_id, text) as a table, optionally with columns whose names clash with the operators' own."""
    if extra:
        return spark.createDataFrame(
            [(i, t, 1.0, "x", True, 7) for i, t in rows],
            "doc_id long, text string, score double, fp string, kept boolean, n_words int")
    return spark.createDataFrame(rows, "doc_id long, text string")


def edge_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long_text = "alpha beta gamma delta " * 8000
    return [
        (1, None), (2, ""), (3, "   \n\t "), (None, "no id here at all"), (4, "one"), (4, "one"),
        (5, long_text), (6, "x" * 70_000), (7, "été \U0001f600 ß İ ﬁ   end"), (8, "<|endoftext|> it's <|im_start|>"),
    ]


def secret_base(text):
    kinds = (
        ("assign", re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
    )
    found = [
        (m.start(), order, kind, m.end())
        for order, (kind, pattern, group, least) in enumerate(kinds) for m in pattern.finditer(text or "")
        if len(m[group]) >= least
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def secret_digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def repeat_counts(text):
    words = WORD.findall(text or "")
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + j for places in windows.values() if len(places) > 1 for i in places for j in range(8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(prints):
    """fingerprint -> smallest fingerprint reachable over links of two bits."""
    distinct, root = sorted(set(prints)), {}
    for start in distinct:
        if start in root:
            continue
        root[start], queue = start, [start]
        while queue:
            here = queue.pop()
            for other in distinct:
                if other not in root and bin(here ^ other).count("1") <= 2:
                    root[other] = start
                    queue.append(other)
    return root


def crc_of_ids(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


def edit_matches(pattern, text):
    """Smallest edit distance of ``pattern`` to any substring of ``text``, and the first end of such a one."""
    previous = list(range(len(pattern) + 1))
    best = len(pattern), 0
    for at, char in enumerate(text, 1):
        current = [0]
        for i, own in enumerate(pattern, 1):
            current.append(min(previous[i - 1] + (own != char), previous[i] + 1, current[i - 1] + 1))
        previous = current
        if current[-1] < best[0]:
            best = current[-1], at
    return best
