"""Perspective rotation against a plain version."""

import random

import pytest

from loadmason.llm.chat_rotation import rotate

from .conftest import clashing

TURN = "conv_id long, turn long, role string, text string"


def plain_rotation(rows, part_turns):
    out = {}
    for conv in sorted({r[0] for r in rows if r[0] is not None}):
        turns = [(t, role if role and role.strip(" ") else None, (text or "").replace("<|", "< |")) for c, t, role, text in rows if c == conv]
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode(), r[2].encode()))
        for person in {r for _, r, _ in turns if r and r != "system"}:
            for part in range(0, len(turns), part_turns):
                rendered, mask, n_own = "", [], 0
                held = turns[part : part + part_turns]
                for _, role, text in held:
                    name = "system" if role == "system" else "assistant" if role == person else "user"
                    if name == "user" and role:
                        clean, last = "", False
                        for c in role:
                            bad = ord(c) <= 0x20 or c in "<|>"
                            clean += "" if bad and last else "_" if bad else c
                            last = bad
                        name += " name=" + clean
                    rendered += f"<|im_start|>{name}\n"
                    if role == person:
                        n_own += 1
                        mask.append((len(rendered), len(rendered) + len(text) + len("<|im_end|>")))
                    rendered += f"{text}<|im_end|>\n"
                out[conv, person, part // part_turns] = (len(held), n_own, rendered, mask)
    return out


def conversations():
    rng = random.Random(3)
    people = ["ann", "bo b", "c<|x", "system", None, "  ", "assistant", "user"]
    rows = []
    for conv in range(12):
        for turn in range(rng.randrange(1, 12)):
            text = rng.choice(["hello", "", None, "<|im_end|> out", "é\U0001f600\nline", "x" * 50])
            rows.append((conv, turn if rng.random() > 0.1 else None, rng.choice(people), text))
    rows += [(5, 3, "ann", "again")] * 3 + [(None, 0, "ann", "lost"), (50, 0, "system", "alone")]
    rows += [(60, t, "ann" if t % 2 else "user", f"turn {t}") for t in range(100)]
    return rows


@pytest.mark.parametrize("part_turns", [512, 4])
def test_rotation(spark, part_turns):
    rows = conversations()
    found = rotate(clashing(spark.createDataFrame(rows, TURN).repartition(5)), part_turns).collect()
    got = {(r.conv_id, r.participant, r.part): (r.n_turns, r.n_own, r.rendered, [(m.start, m.end) for m in r.mask]) for r in found}
    assert len(got) == len(found)
    assert got == plain_rotation(rows, part_turns)
    for _, _, rendered, mask in got.values():
        assert all(rendered[a:b].endswith("<|im_end|>") for a, b in mask)
        assert rendered.count("<|im_start|>assistant\n") == len(mask)


def test_no_rows(spark):
    assert rotate(spark.createDataFrame([], TURN)).count() == 0


def test_nothing_leaves_the_jvm(spark):
    text = rotate(spark.createDataFrame(conversations()[:5], TURN))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text
