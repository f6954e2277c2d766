from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textstyle.llm import QUERIES, repair

FOLLOWS = {"E": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}


def least(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """Cost and audit by trying everything, backwards."""

    @cache
    def rest(i: int, state: str, inserted: int) -> tuple[int, str] | None:
        found = []
        if i == len(rows) and state in "EA":
            found.append((0, ""))

        def add(cost, letter, to):
            if to is not None:
                found.append((cost + to[0], letter + to[1]))

        made = "A" if state == "U" else "U"
        if inserted < 4:
            add(5, "I", rest(i, made, inserted + 1))
        if i < len(rows):
            initial, fault = rows[i]
            add(2, "D", rest(i + 1, state, 0))
            if fault not in ("b", "d"):
                more = 5 * (fault == "t")
                if initial in FOLLOWS[state]:
                    add(more, "K", rest(i + 1, FOLLOWS[state][initial], 0))
                add(1 + more, "R", rest(i + 1, made, 0))
        return min(found, default=None)

    for i in reversed(range(len(rows) + 1)):  # from the end, so that recursion stays shallow
        for state in FOLLOWS:
            rest(i, state, 0)
    return rest(0, "E", 0)


ROWS = st.lists(st.tuples(st.sampled_from("suax "), st.sampled_from(["", "", "b", "d", "t"])), max_size=14)


@given(ROWS)
@settings(max_examples=600, deadline=None)
def test_search_is_least(rows):
    cost, edits = repair.solve(rows)
    assert (cost, edits[::2]) == least(rows)
    initials, k = "", 0
    for letter, made in zip(edits[::2], edits[1::2]):
        if letter != "D":
            initials += made if made != "-" else rows[k][0]
        k += letter != "I"
    assert re.fullmatch("(s?(ua)+)?", initials) and k == len(rows)


@given(ROWS, st.lists(st.integers(1, 4), min_size=1, max_size=20))
@settings(max_examples=400, deadline=None)
def test_segments_join_to_the_same(rows, sizes):
    joined, edits, k = repair.Joined(), "", 0
    while k < len(rows):
        n = sizes[k % len(sizes)]
        results = {}
        for entry in repair.FOLLOWS:
            search = repair.Search(entry)
            for row in rows[k : k + n]:
                search.row(*row)
            results[entry] = (search.taken(), search.ends())
        edits += joined.segment(results)
        k += n
    cost, rest = joined.end()
    assert (cost, edits + rest) == repair.solve(rows)


def nodes_below(node) -> int:
    return 1 + sum(nodes_below(kid) for kid in node.kids)


def test_memory_holds_what_is_open_only():
    search, rng, most = repair.Search(), random.Random(1), 0
    for k in range(20_000):
        fault = rng.choice(["", "", "", "b", "t"])
        search.row("ua"[k % 2] if rng.random() < 0.9 else rng.choice("suax"), fault)
        most = max(most, nodes_below(search.root))
        survivors = [node for _, node in search.paths.values()]
        if k % 500 == 0:  # every leaf is a survivor: nothing dead is kept
            stack, leaves = [search.root], set()
            while stack:
                node = stack.pop()
                stack += node.kids
                assert node.refs == len(node.kids) + survivors.count(node)
                leaves |= {id(node)} if not node.kids else set()
            assert leaves <= {id(n) for n in survivors}
    assert most < 200 and len(search.taken()) > 19_000


def brute(rows: list[tuple]) -> tuple:
    """The contract's row for one conversation of ``(turn, role, text)``."""
    kept = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    seen, codes = set(), []
    for _, role, text in kept:
        ink = text.strip(" \t\n\v\f\r")
        fault = "b" if not ink else "d" if (role, text) in seen else "" if ink[-1] in ".!?" else "t"
        seen.add((role, text))
        codes.append((role[:1], fault))
    if not kept:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    cost, audit = least(codes)
    out, state, k = [], "E", 0
    for letter in audit:
        if letter == "D":
            k += 1
            continue
        role, text = ("", "") if letter == "I" else kept[k][1:]
        made = "a" if state == "U" else "u"
        role = role if letter == "K" else {"a": "assistant", "u": "user"}[made]
        state = FOLLOWS[state][role[:1]]
        out.append(f"{role}:{text}")
        k += letter != "I"
    turns = [t for t, _, _ in kept if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = zip(codes, codes[1:])
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in pairs)
    faults = [sum(f == x for _, f in codes) for x in "bdt"]
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, *faults, illegal, cost, audit, digest)


def damage(rows: list[tuple]) -> dict:
    convs: dict = {}
    for conv, turn, role, text in rows:
        held = convs.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held += [(turn, role, text)] * (2 if kind == 3 else 1)
    return convs


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows: list[tuple], folder: str) -> None:
    schema = "conv_id bigint, turn bigint, role string, text string"
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(f"{folder}/conversations.parquet")
    got = QUERIES["op11_repair"](spark, folder).collect()
    want = {conv: brute(held) for conv, held in damage(rows).items()}
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == want[r["conv_id"]]


def test_query(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    odd = [(900, None, "user", "Hi."), (900, None, "user", "Hi."), (900, 3, None, None),
           (901, None, None, "x"), (902, 1, "assistant", "é !"), (902, 5, "", "No mark"),
           (None, 1, "user", "A."), (None, 2, "assistant", "B. "), (None, 2, "assistant", "B. "),
           (903, 2**40, "user", "."), (903, -5, "system", "Be.\t"), (903, -4, "system", "Be.\t")]
    many = [(904, k, ["user", "assistant"][k % 2], f"Text {k % 61}.") for k in range(700)]
    check(spark, rows + odd + many, str(tmp_path))


def test_empty_table(spark, tmp_path):
    check(spark, [], str(tmp_path))


def summaries(done) -> dict:
    return {r["conv"]: r.asDict() for r in done.summary().collect()}


@pytest.mark.parametrize("segment_rows", [1, 3, 64])
def test_any_segments_give_one_result(spark, segment_rows):
    rng = random.Random(7)
    rows = []
    for conv in [None, *range(6)]:
        for turn in range(rng.choice([1, 2, 40])):
            text = rng.choice(["Well.", "Cut", "", f"T {rng.random()}."])
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "x"]), text, "pos"))
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, mark string")
    whole = repair.repair(frame)
    parts = repair.repair(frame, segment_rows=segment_rows)
    assert summaries(parts) == summaries(whole)
    key = lambda r: (str(r["conv"]), r["step"])
    messages = sorted(parts.messages().collect(), key=key)
    assert messages == sorted(whole.messages().collect(), key=key)
    edits = sorted(parts.edits().collect(), key=key)
    assert [r["step"] for r in edits if r["conv"] is None] == list(range(sum(r["conv"] is None for r in edits)))
    initials: dict = {}
    for r in messages:
        initials[r["conv"]] = initials.get(r["conv"], "") + r["role"][0]
    assert all(re.fullmatch("s?(ua)+", x) for x in initials.values())
