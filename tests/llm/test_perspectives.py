from collections import defaultdict

from earshot.llm import perspectives

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The whole dialogue and its masks, per dialogue and participant."""
    talks = defaultdict(list)
    for r in rows:
        talks[r["conv_id"]].append(r)
    out = {}
    for conv, turns in talks.items():
        turns = sorted(turns, key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"] or "unnamed", r["text"] or ""))
        for own in {r["role"] or "unnamed" for r in turns}:
            text, masks = "", []
            for r in turns:
                name = r["role"] or "unnamed"
                text += "<|assistant|>\n" if name == own else f"<|user {name}|>\n"
                start = len(text)
                text += (r["text"] or "").replace("<|", "< |") + "<|end|>\n"
                if name == own:
                    masks.append((start, len(text)))
            out[conv, own] = (text, masks)
    return out


def joined(rows):
    whole = defaultdict(lambda: ("", []))
    for r in sorted(rows, key=lambda r: r["chunk"]):
        text, masks = whole[r["conv_id"], r["perspective"]]
        assert len(text) == r["start"]
        masks = masks + [(len(text) + m["start"], len(text) + m["end"]) for m in r["masks"]]
        whole[r["conv_id"], r["perspective"]] = (text + r["text"], masks)
    return dict(whole)


def test_whole_table_equals_brute_force(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    want = brute([r.asDict() for r in turns.collect()])
    for chunk in (perspectives.CHUNK, 200):
        rows = [r.asDict() for r in perspectives.render(turns, chunk).collect()]
        assert joined(rows) == want
    assert len(rows) > len(want)


def test_parties_ties_nulls_and_marks(spark):
    rows = [
        (1, 0, "ann", "hi <|end|> there"), (1, 1, "bob", "hello 🙂"), (1, 2, "cem", None), (1, 3, None, "who?"),
        (1, 3, None, "who?"), (1, 4, "ann", ""), (None, 0, "x", "lost"), (None, None, "y", "first"), (2, 0, "solo", "alone"),
    ]
    df = spark.createDataFrame([r + (1, "c") for r in rows], TURNS + ", start long, chunk string")
    want = brute([dict(zip(("conv_id", "turn", "role", "text"), r)) for r in rows])
    got = joined([r.asDict() for r in perspectives.render(df).collect()])
    assert got == want and len(got) == 7
    text, masks = got[1, "ann"]
    assert [text[a:b] for a, b in masks] == ["hi < |end|> there<|end|>\n", "<|end|>\n"]


def test_a_dialogue_that_holds_most_rows(spark):
    rows = [(7, i, f"p{i % 3}", f"turn {i} " + "x" * (i % 50)) for i in range(3000)] + [(8, 0, "p0", "other")]
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    out = [r.asDict() for r in perspectives.render(df, 2000).collect()]
    assert joined(out) == brute([dict(zip(("conv_id", "turn", "role", "text"), r)) for r in rows])
    assert max(len(r["text"]) for r in out) < 2200


def test_empty(spark):
    assert perspectives.render(spark.createDataFrame([], TURNS)).count() == 0
