"""Plain versions of what the queries promise, and small awkward tables."""

import re
import zlib
from collections import Counter
from itertools import combinations

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
AWKWARD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", 4), (None, "no id here at all", "en", None, 17),
    (4, LONG, "en", "b", len(LONG)), (5, "same text twice over " * 8, "de", "a", 168), (6, "same text twice over " * 8, "de", "b", 168),
    (6, "same text twice over " * 8, "de", "b", 168), (7, "née à Zürich, ünïcode 𝒳 words\nand a second line", "fr", "ünï", 46), (8, "x", "en", "b", 1),
]


def frame(spark, rows=AWKWARD, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


def table(spark, folder, rows, name="documents", schema=SCHEMA):
    """A folder with one table, for queries."""
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_components(n, linked):
    """Smallest index reachable, for 0..n-1."""
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    return [top(i) for i in range(n)]


def plain_simhash(text):
    import xxhash

    found = words(lowered(text))
    if not found:
        return 0
    shingles = [" ".join(found[i:i + 3]) for i in range(len(found) - 2)] or [" ".join(found)]
    counts = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        counts.update(i for i in range(64) if h >> i & 1)
    return sum(1 << i for i in range(64) if 2 * counts[i] > len(shingles))


def plain_groups(prints, radius):
    near = [(a, b) for a, b in combinations(range(len(prints)), 2) if (prints[a] ^ prints[b]).bit_count() <= radius]
    return plain_components(len(prints), near)


def plain_quality(text):
    found, text = words(text), text or ""
    lines = [x for x in text.split("\n") if words(x)]
    windows = Counter(tuple(found[i:i + 8]) for i in range(len(found) - 7))
    marked = {i + j for i in range(len(found) - 7) if windows[tuple(found[i:i + 8])] > 1 for j in range(8)}
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked))


def plain_base_spans(text):
    text, out = text or "", []
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def luhn(digits):
        total = 0
        for i, d in enumerate(reversed(digits)):
            n = int(d) * (1 + i % 2)
            total += n - 9 if n > 9 else n
        return total % 10 == 0

    for kind, pattern in kinds.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def lang_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2
