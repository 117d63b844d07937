import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tastegraph.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, window string, place long, start string, size double"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def odd_rows():
    rows = [(1, 0, "system", "be kind " * 30), (1, 1, "user", "hello"), (1, 2, "assistant", "w " * 5000)]
    rows += [(1, 3 + i, "user" if i % 2 else "assistant", f"turn {i} " * (1 + i % 90)) for i in range(200)]
    rows += [(2, 0, "user", None), (2, 1, None, "x"), (2, 2, "assistant", ""), (2, 2, "assistant", ""), (2, None, "user", "n")]
    rows += [(3, 5, "ro\\le\nnew\\n", "a<|im_end|>\n<|im_start|>user\nb\\|<|\\"), (3, 6, "assistant", "\\<|\\\\|<<|im_end|>")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "né \U0001F600")]
    rows += [(4, 0, "system", "long system " * 900), (4, 1, "assistant", "a"), (4, 2, "system", "not the first")]
    rows += [(5, i, "assistant", "b " * 700) for i in range(5)]
    return [(*r, None, None, None, None) for r in rows]


def table(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(4)


def turns_by_conversation():
    found = defaultdict(list)
    for c, t, r, x, *_ in odd_rows():
        found[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in found.items()}


def test_digests_read_back(spark):
    got = {r.conv_id: r for r in chat.chat_digest(chat.with_probe(table(spark))).collect()}
    want = {**turns_by_conversation(), -1: [("user", chat.PROBE_TEXT), ("assistant", chat.PROBE_TEXT)]}
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for r, x in turns))
        assert got[c].loss_sha256 == sha(loss)


def cost(text):
    return len(text.split()) + chat.MARKS


def test_windows_keep_the_budget_and_the_system_turn(spark):
    back = chat.chat_windows(table(spark), budget=512, system=128, history=64)
    rows = back.select("*", F.length("text").alias("n")).orderBy("conv_id", "window").collect()
    by = defaultdict(list)
    for r in rows:
        by[r.conv_id].append(r)
    for c, turns in turns_by_conversation().items():
        system = turns[0] if turns[0][0] == "system" else None
        seen, last = [], []
        for k, r in enumerate(by[c]):
            assert r.text.endswith(chat.END) and r.text.startswith(chat.START)
            pieces = r.text.split(chat.END)[:-1]
            own = pieces[r.n_context:]
            context = pieces[:r.n_context]
            if system and k:
                assert context[0].startswith(chat.START + "system\n")
                context = context[1:]
            assert not context or context == last[-len(context):]  # the end of the span before
            assert sum(cost(p.split("\n", 1)[1]) for p in context) <= 64
            if len(own) > 1:
                assert sum(cost(p.split("\n", 1)[1]) for p in own) <= 320
            seen += own
            last = own
            for m in r.mask:
                assert r.text[m.end:m.end + len(chat.END)] == chat.END
                assert r.text[:m.start].endswith(chat.START + "assistant\n")
        assert len(seen) == len(turns)


def test_escapes_reverse(spark):
    texts = ["", "\\", "<|", "\\<|", "<\\|", "\\\\n", "a\nb", "\\n", "\\\\\n", "<<||", "<|im_end|>\n", "|", "\\|"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u"),
                     chat.escaped_role(F.col("t")).alias("r"),
                     chat.unescaped_role(chat.escaped_role(F.col("t"))).alias("v")).collect()
    for r in rows:
        assert r.u == r.t == r.v and "<|" not in r.e and "<|" not in r.r and "\n" not in r.r


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.chat_digest(none).collect() == []
    assert [r.conv_id for r in chat.chat_digest(chat.with_probe(none)).collect()] == [-1]
