"""Small tables with the cases every operator must stand: nulls, empty and long texts, ties, repeats, odd columns."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, key string, words int, n_lines int, _key int"


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def folded(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def prose(seed, n, vocabulary=400, per_line=9):
    draw = random.Random(seed)
    words = [f"w{draw.randrange(vocabulary)}" if draw.random() < 0.97 else draw.choice(["É", "ÑAndú", "x,", "Don't", "日本"]) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + per_line]) for i in range(0, n, per_line))


def documents():
    passage, base = prose(1, 60), prose(2, 300)
    near = base.split(" ")
    texts = [
        base, base, base + " more", " ".join(near[:200] + ["changed"] + near[201:]), " ".join(near[:150]),
        prose(3, 80) + " " + passage + " " + prose(4, 50), prose(5, 40) + "\n" + passage, passage + " " + passage, passage.upper(),
        "", " \n\t ", None, None, "one", "one", "One", "one two three", "one two three four", prose(6, 12000), "a\nb\nc\nd\na\nb\nc\nx\ny\na\nb\nc\nd",
        "\n\n\n\n\n\n", "same\nsame\nsame\nsame\nsame", prose(7, 20), prose(7, 20), prose(8, 19) + " \x0b " + prose(8, 25), "tail\n", " ".join(["go"] * 90),
    ]
    rows = [(i, t, "en", None if i % 7 == 3 else f"src{i % 3}", None if t is None else len(t), "s", "k", 1, 2, 3) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5]]  # rows that repeat
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(5)


def different(rows):
    """Texts by id, as rows that repeat are one document."""
    return {r[0]: r[1] for r in rows}
