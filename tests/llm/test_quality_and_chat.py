"""Quality rules and chat formatting against plain Python."""

import random
import re

import duckdb
from pyspark.sql import functions as F

from demandspark.llm import chat_format, quality_rules, queries


def brute_quality(t):
    t = t or ""
    words = re.findall("[^\x20\x09-\x0d]+", t)
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = set()
    for i, w in enumerate(wins):
        if wins.count(w) > 1:
            covered |= {i, i + 1, i + 2}
    base = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t),
            len(lines) - len(set(lines)), len(covered), base)


def test_quality_measures(spark):
    r = random.Random(4)
    texts = [None, "", " ", "a", "a a a", "a a a a", "x " * 60, "é b\x0bc", "\n\n\na\na\n a\n"]
    for _ in range(40):
        vocab = ["a", "bé", "c#", "|", "d", "😀"] + [f"w{i}" for i in range(r.choice([3, 200]))]
        texts.append("".join(r.choice(vocab) + r.choice([" ", "\n", "\t", "  "]) for _ in range(r.randint(0, 120))))
    texts += [texts[-1], "word " * 3 + " ".join(f"u{i}" for i in range(5000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = quality_rules.clean_documents(df.selectExpr("*", "'x' as _words", "1 as kept")).orderBy("doc_id").collect()
    assert [(x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) for x in out] == \
        [brute_quality(t) for t in texts]
    assert all(not (x.kept and x.base_failed) for x in out)
    plan = quality_rules.clean_documents(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_quality_lines(spark):
    good = " ".join(f"word{i}" for i in range(60)) + "."
    rows = [(1, f"{good}\nHome | Menu |\nAll rights reserved.\nA#B#C#"), (2, good + "\n" + "NO!! " * 100),
            (3, good + "\n" + "STOP!! THIS!! " + " ".join(f"X{i}!!" for i in range(90)))]
    got = quality_rules.clean_documents(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert got[0].text == good and got[0].kept and got[0].n_lines_removed == 3
    assert not got[1].kept and not got[2].kept


def test_quality_every_phrase_and_line_end(spark):
    """Each navigation word and phrase in any case is found; its keyword gate never skips it."""
    body = " ".join(f"word{i}" for i in range(60)) + "."
    navigation = [x for w in quality_rules.NAVIGATION_WORDS for x in (w + " | a", f"x {w.upper()}", f"{w.capitalize()}\t »")]
    phrases = [x for w in quality_rules.BOILERPLATE_PHRASES
               for x in (f"so {w} it is said here.", w.upper() + " in many words of this line.")]
    ends = ["https://a.b/c?d", " www.x.org ", "this line of many words breaks off ...", "and this one too… ", "Three bare words",
            "one", "#h # a b c d e."]
    stays = ["", "  ", "\t\r", "four words that stay", "Short.", "yes, (it)", "said “no”", "He asked: why?", "the home of a dog.",
             "see https://a.b/c for more of it", "homes | of all the many people", "a menu of the day was read aloud.", "Ja!  no no no no no no no"]
    gone = navigation + phrases + ends
    rows = list(enumerate([f"{body}\n{x}\n{body}" for x in gone + stays] + [None, "", "\n\n"]))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as _lines", "1 as _passed", "2 as line")
    got = {x.doc_id: x for x in quality_rules.clean_documents(df).collect()}
    assert [gone[i] for i in range(len(gone)) if got[i].n_lines_removed != 1 or got[i].text != f"{body}\n{body}"] == []
    assert [x for i, x in enumerate(stays, len(gone)) if got[i].n_lines_removed] == []
    assert [got[len(rows) - k].text for k in (3, 2, 1)] == [None, "", "\n\n"]
    assert quality_rules.clean_documents(df.where("doc_id < 0")).count() == 0
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    expect = con.execute(queries.OP4_SQL)
    names = [c[0] for c in expect.description]
    mine = quality_rules.clean_documents(df).withColumn("clean_chars", F.char_length("text"))
    assert sorted(tuple(x[n] for n in names) for x in mine.collect()) == sorted(expect.fetchall())


def test_chat(spark):
    tricky = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", "&lt;&amp;lt;", "![image](a.png) then ![audio](b&c<d)",
              "![image](a b) ![document]()", "", None, "<|image|>x<|part|>", "$1 \\1 \\", "é😀\n"]
    r = random.Random(1)
    rows = [(c, t, r.choice(["user", "assistant", "system", None, "a<b|&"]), r.choice(tricky), "x")
            for c in range(30) for t in range(r.randint(1, 6))]
    rows += [(30, 1, "assistant", "b", "x"), (30, 1, "assistant", "a", "x"), (30, 1, "assistant", "a", "x"),
             (None, 0, "assistant", "z", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string").repartition(3)
    out = chat_format.format_conversations(df)
    got = out.select("conv_id", "formatted", chat_format.read_turns(out.formatted).alias("turns"),
                     chat_format.read_loss(out.segments).alias("loss"), "segments", "attachments",
                     "expanded_tokens").collect()
    convs = {}
    for c, t, role, text, _ in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2] or "",
                                                           (x[3] or "").replace("&", "&amp;").replace("<", "&lt;"))):
        convs.setdefault(c, []).append((role or "", text or ""))
    assert len(got) == len(convs)
    for x in got:
        assert sorted((t.role, t.text) for t in x.turns) == sorted(convs[x.conv_id])
        assert x.loss == "".join(t.text for t in x.turns if t.role == "assistant")
        assert x.formatted == "".join(s.text for s in x.segments)
        parts = [p for t in x.turns for p in re.findall(r"!\[(image|audio|document)\]\(([^()\s]*)\)", t.text)]
        assert [(p.kind, p.ref) for p in x.attachments] == parts
        assert x.expanded_tokens == sum(chat_format.PART_TOKENS[k] for k, _ in parts)
    assert [t.text for t in next(x for x in got if x.conv_id == 30).turns] == ["a", "a", "b"]
    assert chat_format.format_conversations(df.where("conv_id = 99")).count() == 0


def test_typed_parts(spark):
    """Parts given as a column and parts read from texts, through the visitor and back."""
    r = random.Random(2)
    values = ["", None, "a & b <|turn|>", "$1 \\2", "é😀\n", "x(y) z", "![image](a.png)", "<|image|>x<|part|>", "&lt;"]
    kinds = ["text", "image", "audio", "document", "video", None]
    rows = [(c, t, r.choice(["user", "assistant"]),
             r.choice([None, [(r.choice(kinds), r.choice(values)) for _ in range(r.randint(0, 6))]]))
            for c in range(40) for t in range(r.randint(1, 5))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, content array<struct<kind:string,value:string>>")
    out = chat_format.format_conversations(df.repartition(3), F.col("content"))
    body = F.transform(F.filter(F.split("formatted", "<\\|text\\|>"), lambda x: F.contains(x, F.lit(chat_format.END))),
                       lambda x: chat_format.read_parts(F.split(x, "<\\|end\\|>")[0]))
    got = {x.conv_id: x for x in out.withColumn("read", body).collect()}
    for c in range(40):
        expect, media = [], []
        for _, t, _, content in (x for x in rows if x[0] == c):
            merged = []
            for kind, value in content or []:
                kind, value = kind if kind in chat_format.PART_TOKENS else "text", value or ""
                if kind != "text":
                    media.append((t, kind, value, chat_format.PART_TOKENS[kind]))
                    merged.append((kind, value))
                elif merged and merged[-1][0] == "text":
                    merged[-1] = ("text", merged[-1][1] + value)
                elif value:
                    merged.append(("text", value))
            expect.append(merged)
        assert [[tuple(p) for p in turn] for turn in got[c].read] == expect
        assert [tuple(a) for a in got[c].attachments] == media
        assert got[c].expanded_tokens == sum(m[3] for m in media)
    texts = ["", "![image](a)", "x![audio](b)![document]()y ![image](no part)", "z" * 50000 + "![image](q)"]
    parsed = spark.createDataFrame([(t,) for t in texts], "t string").select(chat_format.parse_parts(F.col("t")).alias("p"))
    assert [[tuple(p) for p in x.p] for x in parsed.collect()] == [
        [], [("image", "a")], [("text", "x"), ("audio", "b"), ("document", ""), ("text", "y ![image](no part)")],
        [("text", "z" * 50000), ("image", "q")]]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_chat_query_against_sql(spark, tmp_path):
    """The registered query on turns that hold media, against its SQL."""
    r = random.Random(3)
    bits = ["hello ", "![image](a&b.png)", "![audio](c<d)", "![document]()", "![image](no part)", "\n", "<|end|>", "é "]
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice([None, "".join(r.choices(bits, k=r.randint(0, 7)))]))
            for c in range(50) for t in range(r.randint(1, 5))]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(path)
    got = queries.op7_chat_format(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS FROM '{path}/*.parquet'")
    expect = con.execute(queries.OP7_SQL)
    names = [c[0] for c in expect.description]
    assert sorted(tuple(x[n] for n in names) for x in got.collect()) == sorted(expect.fetchall())
    assert sum(x.n_parts for x in got.collect()) > 50
