import numpy as np
import pytest

from quarry.llm import chat_hmm as C
from quarry.llm.tables import table


@pytest.mark.parametrize("line, role", [
    ("User: hi", 1), ("**Assistant:** ok", 2), ("### Response", 2), ("### Instructions:", 0), ("<|system|>be", 0), ("[AI] yes", 2), ("q: why", 1), ("A: so", 2),
    ("users: hi", -1), ("A dog", -1), ("plain", -1), ("", -1),
])
def test_markers(line, role):
    assert C.marker(line)[0] == role


def test_table_roles_are_recovered(spark):
    rows = C.format_chats(table(spark, "/root/testdata/sf0.01", "conversations")).collect()
    assert len(rows) == 100 and sum(r.n_agree for r in rows) >= 0.98 * sum(r.n_lines for r in rows)
    for r in rows:
        assert r.rendered.count("<|end|>") == r.n_turns and r.rendered.startswith("<|") and r.rendered.endswith("\n<|end|>")


def test_segments_give_the_same_as_one_search(spark, monkeypatch):
    conversations = table(spark, "/root/testdata/sf0.001", "conversations")
    segments = C.transcripts(conversations)
    model = C.fit(segments)
    monkeypatch.setattr(C, "fit", lambda _: model)
    whole = sorted(C.format_chats(conversations).collect())
    monkeypatch.setattr(C, "SEGMENT", 2)
    assert sorted(C.format_chats(conversations).collect()) == whole


def test_path_is_the_best_of_all(spark):
    rng = np.random.default_rng(2)
    step = rng.integers(0, 9, (C.STATES + 1, C.STATES))
    model = C.Model(step, [rng.integers(0, 9, (C.STATES, n)) for n in C.FEATURES])
    x = np.stack([rng.integers(0, n, 5) for n in C.FEATURES], axis=1)
    emit = model.emit(x)
    import itertools

    score = lambda p: model.step[C.START, p[0]] + emit[0, p[0]] + sum(model.step[a, b] + emit[k + 1, b] for k, (a, b) in enumerate(zip(p, p[1:], strict=False)))
    best = max(itertools.product(range(C.STATES), repeat=5), key=score)
    through = model.through(x)[C.START]
    assert through.max() == pytest.approx(score(best))
    assert tuple(model.path(x, C.START, int(through.argmax()))) == best


def test_defined_cases(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "ok"), (1, 1, "assistant", "ok"), (None, 0, "user", "alone"), (2, None, "user", "no turn"), (3, 0, None, ""), (4, 300, "tool", "late\n\nstart"),
            (5, 0, "user", "line\n" * 5000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    got = C.format_chats(df).collect()
    assert sorted(str(r.conv_id) for r in got) == ["1", "2", "3", "4", "5", "None"]
    assert all(r.n_lines >= r.n_turns >= 1 for r in got)
    assert C.format_chats(df.where("false")).count() == 0
