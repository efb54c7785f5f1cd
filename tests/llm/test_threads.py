"""Quotation linking as a whole against a plain version, message by message."""

import random
import re

import pytest
from pyspark.sql import functions as F

from delaykit.llm.chat_quotes import conversations
from delaykit.llm.queries import mailed

SCHEMA = "message_id bigint, role string, text string"


def level(line):
    return (re.match(r"^[\t ]*((?:>[\t ]?)+)", line) or [""])[0].count(">")


def own(lines):
    last = len(lines) - 1
    stay = [
        line
        for i, line in enumerate(lines)
        if level(line) == 0 and not (re.match(r"(?i)^on .* wrote:[\t ]*$", line) and i < last and level(lines[i + 1]) > 0)
    ]
    return "\n".join(stay).strip(" \t\n\r")


def quoted(lines):
    return [re.sub(r"^[\t ]*>[\t ]?", "", line) for line in lines if level(line) > 0]


def plain(text):
    text = re.sub(r"(?m)^[\t ]*((?:>[\t ]?)+)", r"\1 ", text).replace(">", "> ")
    return re.sub(r"[ \t-\r]+", " ", text).strip(" ").lower()


def parts(text):
    return {p for p in map(plain, re.split(r"\n[\t ]*\n", text)) if p}


def brute_force(rows):
    """(id, parent, root, depth, text, quote depth) of messages with ids of their own."""
    held, read = {}, {}
    for i, _, text in rows:
        lines = (text or "").replace("\r\n", "\n").split("\n")
        inner = quoted(lines)
        context, deeper = plain(own(inner)), plain(own(quoted(inner)))
        entries = [(0, plain(text or "")), (0, plain(own(lines)))]
        entries += [(2, p) for p in parts(own(lines))] + [(1, (p, context)) for p in parts(own(lines)) if context]
        asked = [(0, plain("\n".join(inner)))]
        asked += [(2, p) for p in parts(own(inner))] + [(1, (p, deeper)) for p in parts(own(inner)) if deeper]
        read[i] = asked, own(lines), max(map(level, lines))
        for e in {e for e in entries if e[1]}:
            held.setdefault(e, []).append(i)
    out, done = [], {}
    for i in sorted(read):
        asked, text, depth = read[i]
        found = [(-e[0], max(j for j in held[e] if j < i)) for e in asked if e in held and min(held[e]) < i]
        parent = max(found)[1] if found else None
        root, far = done[parent] if found else (i, -1)
        done[i] = root, far + 1
        out.append((i, parent, *done[i], text, depth))
    return out


def check(spark, rows, slices=4):
    found = conversations(spark.createDataFrame(rows, SCHEMA).repartition(slices)).collect()
    got = sorted((r.message_id, r.parent_id, r.root_id, r.depth, r.text, r.quote_depth) for r in found)
    assert got == brute_force(rows)
    order = {r.message_id: r.place for r in found}
    assert sorted(order.values()) == list(range(len(rows)))
    assert all(order[r.parent_id] < r.place for r in found if r.parent_id is not None)
    by_place = sorted(found, key=lambda r: r.place)
    assert [r.root_id for r in by_place] == sorted(r.root_id for r in found)


def test_threads_of_repeated_passages_against_brute_force(spark):
    rng = random.Random(11)
    phrases = ["thanks", "Shall we go?", "It rains.\n\nTake a coat.", "Two\nlines  here", "OK", "On Friday x wrote:\nnothing", "> "]
    rows = []
    for i in range(400):
        text = rng.choice(phrases) if rng.random() < 0.6 else f"matter {rng.randrange(60)}\n\n{rng.choice(phrases)}"
        if rows and rng.random() < 0.75:
            before = rng.choice(rows[-30:])[2] or ""
            mark = rng.choice(["> ", ">", " > ", ">  "])
            text = "\n".join(([] if rng.random() < 0.5 else ["On Monday a wrote:"]) + [mark + line for line in before.split("\n")]) + "\n" + text
        rows.append((i * 3 + rng.randrange(2), "r", None if rng.random() < 0.02 else text))
    check(spark, rows)


def test_mails_against_brute_force(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    turns = [(c, t, "u", f"{['hello', 'how is it', 'fine', 'ok'][(c * 7 + t * t) % 4]}" + (f" {c} {t}" if t % 2 else "")) for c in range(12) for t in range(9)]
    turns += turns[:20] + [(3, 2, None, None), (None, 1, "u", "x")]
    rows = [tuple(r) for r in mailed(spark.createDataFrame(turns, schema)).select("message_id", "role", "text").collect()]
    check(spark, rows)


def test_a_deep_thread_stays_small(spark):
    rows = [(i, "u", f"> word {i - 1}\n\nword {i}" if i else "word 0") for i in range(600)]
    found = conversations(spark.createDataFrame(rows, SCHEMA))
    assert {(r.root_id, r.depth) for r in found.collect()} == {(0, i) for i in range(600)}
    longest = found.select(F.max(F.length(F.to_json(F.struct(*found.columns))))).first()[0]
    assert longest < 200


@pytest.mark.parametrize("rows", [[], [(None, None, None)] * 3, [(5, "a", "x")] * 4 + [(7, "b", "> x\ny")] * 3])
def test_odd_tables_of_mails(spark, rows):
    named = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "parent", "root", "place", "depth", "lines", "t", "up", "hash", "kind", "range"):
        named = named.withColumn(name, F.lit("clash"))
    found = conversations(named).collect()
    assert len(found) == len(rows)
    assert all(r.parent_id == (5 if r.message_id == 7 else None) for r in found)
    assert all(r.root_id == (5 if r.message_id else None) for r in found)


def test_very_long_mail(spark):
    long = "\n".join(f"line {i} of a very long mail" for i in range(20_000))
    rows = [(1, "a", long), (2, "b", "\n".join("> " + line for line in long.split("\n")) + "\nshort"), (3, "c", "> " * 300 + "deep")]
    found = {r.message_id: r for r in conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[2].parent_id == 1 and found[2].text == "short" and found[1].text == long and found[3].quote_depth == 300
