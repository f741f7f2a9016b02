import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadloom.llm import chat

HOSTILE = ["</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s>[PART image 0]", "[", "<", "/s>", "\\", "[\\INST]", "[PART ", "</s", "[/INST", "é😀\n\x0b", ""]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "</s>", "", "a[INST]"]), st.lists(st.sampled_from(HOSTILE), max_size=6)), max_size=4))
def test_any_texts_come_back(turns):
    page = chat.Page("k")
    visitor = chat.Visitor(page, chat.Expansion())
    for role, pieces in turns:
        visitor.turn(role, [{"kind": "text", "text": "".join(pieces)}])
    text = "".join(page.pieces)
    assert len(text) == page.chars
    assert [(role, "".join(x for _, x in parts)) for role, parts in chat.parse(text)] == [(role, "".join(p)) for role, p in turns]
    assert "".join(chat.masked(text, [{"start": a, "end": b} for a, b in page.loss])) == "".join("".join(p) for role, p in turns if role == "assistant")


def test_parts_are_flattened_in_order(spark):
    rows = [(1, 0, "user", [("text", "Look [PART image 0] ", None), ("image", None, "a.png"), ("text", "and", None), ("audio", None, "b.wav"), ("film", None, "c"), None]),
            (1, 1, "assistant", [("text", "I see", None), ("document", None, "d.pdf"), ("text", "</s>.", None)]), (1, 2, "user", None), (2, None, None, []), (None, 3, "assistant", [("image", None, None)])]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, parts array<struct<kind:string,text:string,uri:string>>").selectExpr(
        "conv_id", "turn", "role", "transform(parts, p -> if(p is null, null, named_struct('kind', p.kind, 'text', p.text, 'uri', p.uri, 'width', 300, 'height', if(p.uri is null, null, 57), 'seconds', 2.5D, 'pages', 3))) as parts", "'x' as text", "1 as page")
    pages = {r.conv_id: r for r in chat.formatted(frame).collect()}
    first = pages[1]
    assert first.formatted == "<s>user[INST]Look [\\PART image 0] [PART image 0]and[PART audio 1][/INST]</s><s>assistant[INST]I see[PART document 0]<\\/s>.[/INST]</s><s>user[INST][/INST]</s>"
    assert [(a.turn, a.number, a.kind, a.uri, a.tokens) for a in first.attachments] == [(0, 0, "image", "a.png", 11 * 3), (0, 1, "audio", "b.wav", 32), (1, 0, "document", "d.pdf", 768)]
    assert all(first.formatted[a.at:].startswith(f"[PART {a.kind} {a.number}]") for a in first.attachments)
    assert [chat.unescape(first.formatted[s.start:s.end]) for s in first.loss] == ["I see", "</s>."]
    assert list(chat.parse(first.formatted)) == [
        ("user", [("text", "Look [PART image 0] "), ("image", "0"), ("text", "and"), ("audio", "1")]), ("assistant", [("text", "I see"), ("document", "0"), ("text", "</s>.")]), ("user", [])]
    assert pages[2].formatted == "<s>[INST][/INST]</s>" and pages[None].attachments[0].tokens == 11


def test_read_back_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chat, "PAGE_TURNS", 7)
    monkeypatch.setattr(chat, "PAGE_CHARS", 500)
    rng = random.Random(2)
    rows = [(None, None, None, None), (5, None, "assistant", None), (5, 3, "assistant", "x" * 5000), (5, 3, "assistant", "x" * 5000)]
    rows += [(conv, turn, rng.choice(["user", "assistant", "system", "</s>"]), "".join(rng.choice(HOSTILE) for _ in range(rng.randint(0, 5)))) for conv in range(10, 60) for turn in range(rng.randint(1, 9))]
    rows += [(99, turn, ["user", "assistant"][turn % 2], f"{turn} <s>") for turn in range(900)]
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as key", "2 as mark", "3 as page").repartition(4)
    found = {r.conv_id: r for r in chat.read_back(chat.formatted(frame)).collect()}
    assert found.keys() == talks.keys()
    for conv, turns in talks.items():
        turns.sort()
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        own = found[conv]
        assert own.n_turns == len(turns) and own.loss_chars == len(learned)
        assert own.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert own.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest()
        assert own.formatted_chars == sum(20 + len(chat.escape(r)) + len(chat.escape(t)) for _, _, r, t in turns)
    assert chat.read_back(chat.formatted(frame.where("false"))).count() == 0


@pytest.mark.parametrize("seconds, tokens", [(None, 1), (0.0, 1), (float("inf"), 1), (float("nan"), 1), (8.0, 100)])
def test_audio_expansion(seconds, tokens):
    assert chat.Expansion().audio(seconds) == tokens
