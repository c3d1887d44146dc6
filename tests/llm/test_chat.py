import random
import re

import pytest
from lodestack.llm import chat as C

PUNCT = re.compile(r"[\s!-/:-@\[-`{-~]+")
SCHEMA = "conv_id long, turn long, role string, text string"


def normal(text):
    return PUNCT.sub(" ", text.lower()).strip(" ")


def parse(text):
    out = []
    for raw in re.split(r"\r?\n", text or ""):
        marks = re.match(r"[ \t]*((?:>[ \t]?)+)", raw)
        out.append((marks[1].count(">"), raw[marks.end() :]) if marks else (0, raw))
    return out


def shingles(words):
    w = words.split(" ") if words else []
    return {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def said_by(text):
    own = "\n".join(p if not level else "" for level, p in parse(text))
    whole = {normal(x) for x in [*own.split("\n"), *re.split(r"\n\s*\n", own), own]} - {""}
    return whole, shingles(normal(own)) | whole


def passages(text):
    out, last = [], None
    for no, (level, plain) in enumerate(parse(text)):
        if level != last and level:
            out.append((level, no, []))
        if level:
            out[-1][2].append(plain)
        last = level
    return [(level, no, normal(" ".join(own))) for level, no, own in out if normal(" ".join(own))]


def brute(messages):
    """One conversation of distinct turns by plain loops, from the rules as format_chats and link_quotes state them."""
    messages = sorted(messages)
    says, rows, children, parent = [said_by(text) for _, _, text in messages], [], {}, {}
    for k, (_, _, text) in enumerate(messages):
        found = []
        for level, no, words in passages(text):
            to = max((i for i in range(k) if words in says[i][0]), default=None)
            if to is None:
                own = shingles(words)
                named = {max((i for i in range(k) if s in says[i][1]), default=None) for s in own} - {None}
                share, to = max(((len(own & says[i][1]) / len(own), i) for i in named), default=(0, None))
                to = to if share >= 0.8 else None
            if to is not None:
                found.append((level, no, to))
        parent[k] = min(found)[2] if found else k - 1
        children.setdefault(parent[k], []).append(k)
        lines = parse(text)
        body = "\n".join(p for level, p in lines if not level)
        rows.append([body.strip() if any(level for level, _ in lines) else (text or ""), max(level for level, _ in lines), len(found)])
    order, stack = [], [0]
    while stack:
        at = stack.pop()
        order.append(at)
        stack += reversed(children.get(at, []))
    place, depth, thread, out = {k: n for n, k in enumerate(order)}, {}, {}, []
    for k, (turn, role, _) in enumerate(messages):
        depth[k] = 0 if k == 0 else depth[parent[k]] + 1
        thread[k] = k if k == 0 or parent[k] != k - 1 else thread[k - 1]
        out.append((turn, role, *rows[k], messages[parent[k]][0] if k else None, messages[thread[k]][0], depth[k], k, place[k]))
    return out


def random_conversations():
    pick, convs = random.Random(2), {}
    for conv in [*range(25), None]:
        messages, texts, n = [], [], pick.choice([1, 4, 9, 150])
        for turn in range(n):
            text = []
            for _ in range(pick.randint(0, 2)):
                if texts:
                    words = pick.choice(texts).upper().replace(" ", "  ").split()
                    a = pick.choice([0, 0, pick.randrange(len(words))])
                    words = words[a : a + pick.choice([len(words), 7, 12])]
                    if len(words) > 6 and pick.random() < 0.3:
                        words[-1] = "altered"
                    cut, mark = pick.randrange(len(words) + 1), pick.choice(["> ", ">> ", "> > ", ">"])
                    text += [mark + " ".join(w) + "!" for w in (words[:cut], words[cut:]) if w] + pick.choice([[], ["> never said before"], ["   "], [""]])
            own = [" ".join(pick.choice(["red", "green", "blue", f"w{conv}", f"t{turn}", f"n{k}"]) for k in range(pick.choice([1, 4, 5, 20]))) for _ in range(pick.randint(0, 3))]
            texts += own
            messages.append((turn, pick.choice(["user", "assistant"]), "\n".join(text + own) if pick.random() > 0.03 else None))
        convs[conv] = messages
    return convs


def turns(*texts):
    return [(k, "user", t) for k, t in enumerate(texts)]


LONG = 3 * C.CELL + 5
ORDER, WRAPPED, COMMON, CELLS = 100, 101, 102, 103
CONVS = random_conversations() | {
    ORDER: turns("first thing", "second thing", "third thing", "> first thing\nto the first", "> second thing\nto the second", "on", "> third thing\nto the third", "> second thing\nagain"),
    WRAPPED: turns("a quoted line of several words\nHi", "Hi", "> a quoted line\n> of several words", "> Hi", "one two three four five six seven eight nine ten", "x", "> one two three four five six seven eight nine eleven", "> five six nothing eight nine ten"),
    COMMON: [(1, "user", "Hi\nThanks"), (5, "user", "Hi\nthe content\nThanks"), (6, "user", "Hi"), (7, "user", "> Hi\n> the content\n> Thanks\nyes"), (9, "user", "> hi\n>> thanks\n> Hi")],
    CELLS: turns(*[f"> first\nline {k}" if k in (7, 2 * C.CELL + 3) else ("first" if k == 0 else f"line {k}") for k in range(LONG)]),
}
ODD = [(201, None, None, None), (201, 0, "user", ""), (201, 0, "assistant", "x"), (202, 5, "user", "> " * 50 + "deep"), (202, 6, "user", "a\n" * 20_000), (202, 7, "user", "> a\n" * 20_000), (203, -70, "user", "below"), (203, -3, "user", "> below")]


@pytest.fixture(scope="module")
def got(spark):
    """All conversations in one run, by conversation and turn order."""
    rows = [(conv, *m, "clash", 1) for conv, messages in CONVS.items() for m in messages]
    rows += [(conv, *messages[0], "clash", 1) for conv, messages in CONVS.items()]  # repeated
    rows += [(*r, "clash", 1) for r in ODD]
    out = {}
    for r in sorted(C.format_chats(spark.createDataFrame(rows, SCHEMA + ", thread string, position int")).collect(), key=lambda r: r.position):
        out.setdefault(r.conv_id, []).append(r)
    return out


def test_against_brute_force(got):
    for conv, messages in CONVS.items():
        assert [tuple(r)[1:] for r in got[conv]] == brute(messages)
    every = [r for own in got.values() for r in own]
    assert sum(r.linked_quotes for r in every) > 100 and len({r.thread for r in every}) > 5
    assert sum(r.position != r.reply_position for r in every) > 100


def test_reply_order_is_not_turn_order(got):
    assert [r.turn for r in sorted(got[ORDER], key=lambda r: r.reply_position)] == [0, 1, 2, 6, 4, 5, 7, 3]
    by = {r.turn: r for r in got[ORDER]}
    assert (by[4].depth, by[5].depth, by[6].depth, by[3].depth) == (2, 3, 3, 1)


def test_quotes_however_wrapped(got):
    by = {r.turn: r for r in got[WRAPPED]}
    assert [by[k].reply_to for k in (2, 3, 6, 7)] == [0, 1, 4, 6]
    assert [by[k].linked_quotes for k in (2, 3, 6, 7)] == [1, 1, 1, 0]


def test_common_lines(got):
    """A passage of lines that many say links to the message that says it as a whole."""
    assert {r.turn: r.reply_to for r in got[COMMON]}[7] == 5


def test_no_cell_takes_a_long_conversation(got):
    by = {r.turn: r for r in got[CELLS]}
    assert [by[k].thread for k in (0, 6, 7, 2 * C.CELL, 2 * C.CELL + 3, LONG - 1)] == [0, 0, 7, 7, 2 * C.CELL + 3, 2 * C.CELL + 3]
    assert by[7].reply_to == 0 and by[8].reply_to == 7 and [by[k].position for k in range(LONG)] == list(range(LONG))


def test_edges(spark, got):
    assert C.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [r.position for r in got[201]] == [0, 1, 2] and max(r.quote_depth for r in got[202]) == 50
    assert {(r.turn, r.reply_to) for r in got[202]} == {(5, None), (6, 5), (7, 6)}
    assert {(r.turn, r.reply_to) for r in got[203]} == {(-70, None), (-3, -70)}
