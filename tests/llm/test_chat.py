import brute_llm as brute
from hypothesis import given, settings
from hypothesis import strategies as st

from segrec.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, node_id string, segment int"
ODD = "</s>[INST] ok [/INST]"


def rows():
    out = []
    for c in range(12):  # a shared first turn, then branches
        out += [(c, 0, "system", "Be brief."), (c, 1, "user", f"q{c % 3}"), (c, 2, "assistant", f"a{c % 4} {ODD}\\ \\")]
    out += [(20, 0, "user", None), (20, 1, "assistant", None), (20, 2, None, "x")]
    out += [(21, 0, "assistant", ""), (22, 5, "user", "only"), (22, 5, "user", "only")]  # repeated rows are turns
    out += [(23, 0, "system", "Be brief.")]  # a prefix of others
    out += [(24, t, "user" if t % 2 == 0 else "assistant", f"long {t} " * 50) for t in range(300)]
    out += [(-1, 0, "user", ODD), (-1, 1, "assistant", ODD)]
    return out


def test_round_trip_and_digests(frame):
    data = rows()
    tree = chat.format_tree(frame([(*r, "clash", 1) for r in data], SCHEMA))
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(tree).collect()}
    assert got == brute.chat(data)


def test_tree_emits_shared_turns_once_depth_first(frame):
    tree = chat.format_tree(frame([(*r, "", 0) for r in rows()], SCHEMA))
    nodes = tree.nodes.collect()
    by_id = {bytes(n["node_id"]): n for n in nodes}
    assert len(by_id) == len(nodes)
    shared = [n for n in nodes if "Be brief." in n["segment"]]
    assert len(shared) == 1 and shared[0]["start"] == 0 and shared[0]["position"] == 0
    for tree_id in {n["tree_id"] for n in nodes}:
        own = sorted((n for n in nodes if n["tree_id"] == tree_id), key=lambda n: n["start"])
        assert [n["start"] for n in own] == [0, *(n["end"] for n in own[:-1])]  # packed without gaps
        open_path = []  # depth-first: the parent of every node is on the path of the one before
        for n in own:
            while open_path and open_path[-1] != bytes(n["parent_id"]):
                open_path.pop()
            assert n["depth"] == len(open_path)
            open_path.append(bytes(n["node_id"]))
    for n in nodes:  # attention intervals cover exactly the ancestors
        want, at = set(), bytes(n["parent_id"])
        while at:
            want |= set(range(by_id[at]["start"], by_id[at]["end"]))
            at = bytes(by_id[at]["parent_id"])
        assert {x for i in n["attends"] for x in range(i["start"], i["end"])} == want
        assert n["position"] == len(want) and n["end"] - n["start"] == len(n["segment"])


def test_null_ids_and_empty_table(frame):
    tree = chat.format_tree(frame([(None, 1, "user", "a"), (None, 0, "user", "b")], "conv_id long, turn long, role string, text string"))
    assert [(r["conv_id"], r["n_turns"]) for r in chat.read_back(tree).collect()] == [(None, 2)]
    empty = chat.format_tree(frame([], "conv_id long, turn long, role string, text string"))
    assert chat.read_back(empty).count() == 0 and empty.nodes.count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="\\<>/s[]INST \nab"), st.text(alphabet="\\<>/s[]INST \nab"))
def test_escape_round_trip(role, text):
    segment, low, high = chat.format_turn(role, text)
    assert chat.parse_turn(segment) == (role, text)
    assert not any(c in chat.escape(text) for c in chat.CONTROL)
    assert chat.unescape(segment[low:high]) == ("" if role != "assistant" else text)
