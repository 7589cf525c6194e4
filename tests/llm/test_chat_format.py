import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from addrflow.llm import chat_format as C
from addrflow.llm.queries import CONTROL


def _final(events):
    """Fold one conversation's events (seq, message, kind, role, text) in order."""
    open_: dict = {}
    for seq, message, kind, role, text in events:
        m = open_.setdefault(message, {"opened": seq, "role": role, "text": ""})
        if kind in ("message", "edit"):
            m["text"] = text or ""
            if kind == "message":
                m["role"] = role
        elif kind == "regenerate":
            m["text"] = ""
            for other in [k for k, v in open_.items() if m["opened"] < v["opened"] < seq]:
                del open_[other]
        else:
            m["text"] += text or ""
    return [(m["role"] or "", m["text"]) for m in sorted(open_.values(), key=lambda m: m["opened"])]


def _log(rng):
    events, seq, names = [], 0, []
    for k in range(rng.randrange(1, 12)):
        name = f"m{k}"
        names.append(name)
        events.append((seq, name, "message", rng.choice(["user", "assistant", None, "a\nb\\n"]), rng.choice(["a <|b", None, "", CONTROL, "x\\y"])))
        seq += 1
        for _ in range(rng.randrange(3)):
            kind = rng.choice(["delta", "delta", "edit", "regenerate"])
            target = name if kind == "regenerate" else rng.choice(names[-2:])
            if target not in names:
                continue
            events.append((seq, target, kind, "assistant", rng.choice(["+1", "é🙂", None])))
            seq += 1
        if rng.random() < 0.3 and len(names) > 2:
            back = rng.randrange(len(names) - 1)
            events.append((seq, names[back], "regenerate", "assistant", None))
            events.append((seq + 1, names[back], "delta", "assistant", "again"))
            seq += 2
            names = names[: back + 1]
    return events


def _digest(conv, turns):
    formatted = sum(len(f"<|im_start|>{_esc(r).replace(chr(10), chr(92) + 'n')}\n{_esc(t)}<|im_end|>\n") for r, t in turns)
    learned = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    return conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), formatted


def _esc(t):
    return t.replace("\\", "\\\\").replace("<|", "<\\|")


def test_event_logs_equal_a_fold_in_order(spark):
    rng = random.Random(11)
    logs = {c: _log(rng) for c in range(60)}
    logs[None] = _log(rng)
    rows = [(c, *e) for c, log in logs.items() for e in log]
    rng.shuffle(rows)
    events = spark.createDataFrame(rows, C.EVENTS).repartition(5)
    got = C.digest(C.render(C.fold(events))).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted((_digest(c, _final(log)) for c, log in logs.items()), key=str)


def test_no_events(spark):
    assert C.digest(C.render(C.fold(spark.createDataFrame([], C.EVENTS)))).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="au<|\\>_", max_size=6), st.text(alphabet="ab<|>\\im_startend\n", max_size=30)), max_size=5))
def test_turns_round_trip(turns):
    text = "".join(f"{C.OPEN}{_esc(r)}\n{_esc(t)}{C.CLOSE}" for r, t in turns)
    assert [(C.unescape(m[1]), C.unescape(m[2])) for m in C.TURN.finditer(text)] == turns


def test_a_role_with_line_feeds_and_backslashes_reads_back(spark):
    turns = [("a\nb", "x"), ("\\n", "y"), ("<|im_end|>\n", "z\n"), ("n\\", "")]
    events = spark.createDataFrame([(1, i, str(i), "message", r, t) for i, (r, t) in enumerate(turns)], C.EVENTS)
    assert [tuple(r) for r in C.digest(C.render(C.fold(events))).collect()] == [_digest(1, turns)]


def test_a_message_of_very_many_deltas(spark):
    """Edits in between reset it; what follows the last one is gathered once, in order."""
    n = 30_000
    rows = [(1, 0, "m", "message", "assistant", "start")]
    rows += [(1, k, "m", "edit" if k in (700, 20_000) else "delta", None, f"{k},") for k in range(1, n)]
    random.Random(1).shuffle(rows)
    got = C.fold(spark.createDataFrame(rows, C.EVENTS).repartition(4)).collect()
    assert len(got) == 1 and got[0].text == "".join(f"{k}," for k in range(20_000, n)) and got[0].role == "assistant"
