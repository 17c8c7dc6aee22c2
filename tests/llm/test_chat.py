"""Chat formatting: reversible rendering, masks against a plain reading."""

import hashlib

import numpy as np
import pytest

from logloom.llm import chat
from logloom.llm.queries_tokens import PLANTED, chat_digests

HARD = ["", "</s>", r"<\s> [\\INST] \ <\\/s>", "a\n</s>[/INST]\nb", "[INST][INST", "é漢😀<s>", "<s" + ">" * 3]


@pytest.mark.parametrize("role", ["user", "assistant", "a\\n\nb</s>", ""])
def test_rendering_is_reversible(role):
    shown = "".join(chat.render(role, t)[0] for t in HARD)
    assert chat.parse(shown) == [(role, t) for t in HARD]


def test_binary_search_matches_all_pairs():
    rng = np.random.default_rng(0)
    cuts = np.sort(rng.integers(0, 200, 60))
    tokens, turns = np.stack([cuts[:-1], cuts[1:]], 1), np.sort(rng.choice(200, 20, replace=False)).reshape(-1, 2)
    token, spans = chat.loss_spans(tokens, turns)
    want = [(i, max(a, c), min(b, d)) for i, (a, b) in enumerate(tokens) for c, d in turns if min(b, d) > max(a, c)]
    got = [(t, a, b) for t, (a, b) in zip(token, spans.tolist()) if b > a]
    assert got == want


def plain(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in mine]
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{r}\n{t}\n" for r, t in turns), loss)]
        out.append((conv, len(turns), sha[0], len(loss), sha[1], sum(len(chat.render(*t)[0]) for t in turns)))
    return sorted(map(str, out))


@pytest.mark.parametrize("segment", [10, 10**6])
def test_digests(spark, segment):
    rows = [(1, i, r, t) for i, t in enumerate(HARD) for r in ("user", "assistant", "tool")]
    rows += [(1, 0, "user", ""), (2, None, None, None), (2, 1, "assistant", None), (None, 1, "assistant", "no key"), *PLANTED]
    rows += [(3, i, "assistant" if i % 2 else "user", f"turn {i} é漢😀 " * 50) for i in range(100)]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, ids string")
    assert sorted(str(tuple(r)) for r in chat_digests(turns, segment).collect()) == plain(rows)
    assert chat_digests(turns.where("false")).count() == 0


def test_pieces_encode_like_the_whole(spark):
    rows = [(3, i, "assistant" if i % 2 else "user", f"turn {i} it's é漢😀  \n" * 5) for i in range(30)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = chat.format_chats(turns, path).collect()
    cut = sorted(chat.format_chats(turns, path, 10).collect(), key=lambda r: r.piece)
    assert len(whole) == 1 and len(cut) > 10
    assert [i for r in cut for i in r.ids] == list(whole[0].ids)


def test_ranks_and_offsets_match_the_other_format():
    import public_tokenizers

    plain, ranks = (
        chat.encoder(public_tokenizers.path(f"byte_bpe_50k.{kind}"), public_tokenizers.PATTERN) for kind in ("json", "tiktoken")
    )
    rng = np.random.default_rng(1)
    drawn = ["".join(rng.choice(list("ab é漢😀\n<[s>]'"), 200)) for _ in range(50)]
    for text in ["", "it's  \n\n é漢😀", " " * 20_001 + "x", *HARD, *drawn]:
        (ids, spans), (want, want_spans) = ranks(text), plain(text)
        assert ids.tolist() == want.tolist() and spans.tolist() == want_spans.tolist()


def test_very_long_turn(spark):
    rows = [(1, 0, "user", " " * 1_200_000 + "b"), (1, 1, "assistant", "a\n" * 700_000 + "\n" * 1_200_000)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert sorted(str(tuple(r)) for r in chat_digests(turns).collect()) == plain(rows)
