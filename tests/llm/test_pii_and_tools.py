import json
import random
import re

import pytest
from conftest import EDGES
from pyspark.sql import functions as F

from wardlake.llm import pii, toolcalls

TEXTS = [
    (1, "Write to ann.lee7@mail2.example.com or call +1 (915) 555-2271."),
    (2, "ann.lee7@mail2.example.com, bob@mail2.example.com; card 4539 5787 6362 1486 and 4539578763621486"),
    (3, 'token = "77bbad26ca7ed0a1736a7470461894fd3b9ac859" from 35.160.182.195, password=e3b3ed3c!'),
    (4, "Mrs Ada Byron met Mr. Byron and MR. BYRON."),
    (5, "Госпожа Анна Петрова и Господин Петрова"),
    (6, "Nothing here, 42 apples and 1999 pears."),
    (7, "SSN 123-45-6789; IBAN DE89 3704 0044 0532 0130 00; 2001:0db8:85a3:0000:0000:8a2e:0370:7334"),
]


def run(df):
    return {(r.doc_id, i): r for i, r in enumerate(pii.replace(df, "k").orderBy(F.expr("doc_id NULLS FIRST")).collect())}


def test_surrogates_keep_type_format_and_coreference(make_docs):
    out = {r.doc_id: r for r in pii.replace(make_docs(TEXTS), "k").collect()}
    old = dict(TEXTS)
    assert out[6].clean_text == old[6] and out[6].n_entities == 0
    for i, t in TEXTS:
        for private in re.findall(r"\S+@\S+|[\d.]{12,}|[0-9a-f]{20,}|\d{4} \d{4}|555-\d+|Byron|Ada|Анна", t):
            assert private.strip(";,.") not in out[i].clean_text, private
    mail = r"[a-z]+\.[a-z]+\d@([a-z]+\d\.[a-z]+\.com)"
    one, two = re.search(mail, out[1].clean_text), re.search(mail, out[2].clean_text)
    assert one.group() == two.group()                                   # the same address, in two texts
    assert re.search(r"; card", out[2].clean_text) and out[2].clean_text.count(one.group(1)) == 2   # the same host
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}\.$", out[1].clean_text)
    a, b = re.search(r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{16})$", out[2].clean_text).groups()
    assert a.replace(" ", "") == b and b[0] == "4" and luhn(b) == luhn("4539578763621486")
    assert re.search(r'token = "[0-9a-f]{40}" from (\d+\.){3}\d+, password=[a-f0-9]{8}|password=\S{9}', out[3].clean_text)
    first, last, same, loud = re.fullmatch(r"Mrs (\w+) (\w+) met Mr\. (\w+) and MR\. (\w+)\.", out[4].clean_text).groups()
    assert loud == last.upper()
    assert last == same and first[0].isupper() and first.endswith("a")
    assert re.fullmatch(r"[Ѐ-ӿ ]+", out[5].clean_text)


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def test_one_person_has_one_name_in_every_form(make_docs):
    texts = [(1, "Dr James Byron wrote. James Byron came, and JAMES Byron's dog; Byron's house, BYRON too. A byronic day."),
             (2, "Ms Ada Byron and Dr Ada Byron and mr. ada? no: mr. Byron, MISS Ada Quill"), (3, "Dr Robin Vale, Herr Robin Vale, Robin went"),
             (4, "Byron alone, James alone, in a text that names nobody")]
    out = {r.doc_id: r.clean_text for r in pii.replace(make_docs(texts), "k").collect()}
    james, byron = re.match(r"Dr (\w+) (\w+) wrote", out[1]).groups()
    assert out[1] == (f"Dr {james} {byron} wrote. {james} {byron} came, and {james.upper()} {byron}'s dog; {byron}'s house, {byron.upper()} too. "
                      "A byronic day.")
    ada, quill = re.search(r"MISS (\w+) (\w+)", out[2]).groups()
    assert out[2] == f"Ms {ada} {byron} and Dr {ada} {byron} and mr. ada? no: mr. {byron}, MISS {ada} {quill}"
    assert james[-1] in "nrsk" and ada[-1] == "a"                   # gender from the list, and from the titles
    robin = re.match(r"Dr (\w+) ", out[3]).group(1)
    assert robin[-1] in "nrsk" and out[3].count(robin) == 3         # Herr says so, of Dr Robin too
    assert out[4] == texts[3][1]


def test_what_is_no_card_stays_and_short_addresses_go(make_docs):
    texts = [(1, "order 4539578763621486 and 4539578763621487, 1234567890123456"), (2, "ping 2001:db8::1 or ::1, fe80::a1:2, not a::b nor 12::30:45x"),
             (3, "a@b.example.org b@c.example.org a@c.example.org"), (4, "std::vector at 10:30:45, ratio 3:4")]
    out = {r.doc_id: r for r in pii.replace(make_docs(texts), "k").collect()}
    assert out[1].n_entities == 1 and "4539578763621487, 1234567890123456" in out[1].clean_text and "4539578763621486" not in out[1].clean_text
    six = re.fullmatch(r"ping ([0-9a-f:]+) or (::\d), ([0-9a-f:]+), not a::b nor 12::30:45x", out[2].clean_text).groups()
    assert six[0] != "2001:db8::1" and re.fullmatch(r"\d{4}:[a-f]{2}\d::\d", six[0]) and six[1] != "::1"
    boxes = [x.split("@") for x in out[3].clean_text.split()]
    assert boxes[1][1] == boxes[2][1] != boxes[0][1] and len({tuple(b) for b in boxes}) == 3
    assert out[4].clean_text == texts[3][1]


def test_short_hosts_stay_apart(make_docs):
    pairs = [(i, f"x@{a}.{b}.org") for i, (a, b) in enumerate((a, b) for a in "abcdefghij" for b in "klmnopqrst")]
    out = [r.clean_text.split("@")[1] for r in pii.replace(make_docs(pairs), "k").collect()]
    assert len(set(out)) == 100 and not set(out) & {t.split("@")[1] for _, t in pairs}


def test_surrogates_are_distinct_and_new(spark):
    values = [f"{i:02d}" for i in range(0, 60, 3)]
    df = spark.createDataFrame([("secret", v, "n") for v in values], "kind string, value string, gender string")
    new = [r.new for r in pii.assign(df, "k").collect()]
    assert len(new) == len(set(new)) == len(values) and not set(new) & set(values)


def test_formats_without_a_free_value_get_wider(spark):
    values = [f"{i:02d}" for i in range(100)] + ["****", "----", "____", "密码密码", "٣٤٥٦"]
    rows = [("secret", v) for v in values] + [("ssn", f"{i}") for i in range(10)]
    df = spark.createDataFrame([(*r, "n") for r in rows], "kind string, value string, gender string")
    new = [(r.kind, r.new) for r in pii.assign(df, "k").collect()]
    assert len(new) == len(set(new)) == len(rows) and not set(new) & set(rows)
    assert all(re.fullmatch(r"[a-z0-9]+", n) for _, n in new)


def test_masked_secrets_are_replaced(make_docs):
    texts = [(1, "password: **** and token: ----"), (2, "Password: ____"), (3, "secret=密码是一二三四"), (4, "token=1234")]
    for r in pii.replace(make_docs(texts), "k").collect():
        assert r.n_entities == (2 if r.doc_id == 1 else 1) and not re.search(r"[*_密一]|----|1234", r.clean_text)


def test_key_changes_surrogates(make_docs):
    df = make_docs(TEXTS[:1])
    assert pii.replace(df, "a").first().clean_text != pii.replace(df, "b").first().clean_text


def test_texts_without_entities_pass_unchanged(make_docs):
    pairs = [x for x in EDGES]
    got = sorted([(r.doc_id, r.clean_text, r.row.row) for r in pii.replace(make_docs(pairs), "k").collect()], key=repr)
    assert got == sorted([(i, t, "r") for i, t in pairs], key=repr)
    assert pii.replace(make_docs([]), "k").count() == 0
    twice = pii.replace(make_docs([(None, "a@b.example.org"), (None, "a@b.example.org")]), "k").collect()
    assert len({r.clean_text for r in twice}) == 1 and "a@b" not in twice[0].clean_text and len(twice) == 2


SCHEMAS = {"t": {"type": "object", "required": ["n"], "additionalProperties": False, "properties": {
    "n": {"type": "integer", "minimum": 0}, "after": {"type": "array"}}}}
CALLS = "conv_id long, call_id string, name string, arguments string, position long, line string"
RESULTS = "conv_id long, call_id string, content string, position long, status string"


@pytest.mark.parametrize("text, fine", [
    ('{"n": 1}', True), ('{"n": 1.0}', True), ('{"n": true}', False), ('{"n": -1}', False), ("{}", False), ('{"n":1,"x":2}', False),
    ('{"n":1,"n":2}', False), ('{"n": NaN}', False), ("[", False), ("", False), (None, False), ('"\\ud800"', False),
    ("[" * 100000, False)])
def test_arguments_are_validated(text, fine):
    assert (toolcalls.check("t", text, SCHEMAS)[1] == []) == fine


def test_canonical_json():
    assert toolcalls.check("t", '{ "b" : [1.0, 2.5], "a":{"d":"é","c":null} }', {})[0] == '{"a":{"c":null,"d":"é"},"b":[1,2.5]}'


def test_levels_equal_brute_force(spark):
    rnd = random.Random(6)
    calls, want = [], {}
    for conv in range(12):
        n = rnd.randint(1, 9)
        order = list(range(n))
        rnd.shuffle(order)
        deps = {i: [j for j in order[:order.index(i)] if rnd.random() < 0.4] for i in order}
        if conv % 4 == 3 and n > 1:
            deps[order[0]].append(order[-1])
            deps[order[-1]] = list({*deps[order[-1]], order[0]})
        level = {}

        def depth(i, path=()):
            if i in path:
                return None
            if i not in level:
                below = [depth(j, (*path, i)) for j in deps[i]]
                value = None if None in below else 1 + max(below, default=-1)
                if value is None:
                    return None
                level[i] = value
            return level[i]
        for i in order:
            want[conv, f"c{i}"] = depth(i)
            args = json.dumps({"n": i, "after": [{"$ref": f"c{j}"} for j in deps[i]]})
            calls.append((conv, f"c{i}", "t", args, i, "x"))
    out = toolcalls.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), SCHEMAS).collect()
    assert {(r.conv_id, r.call_id): r.level for r in out} == want
    assert all(r.valid == (r.level is not None) and r.status == "no_result" for r in out)


def test_linking_edge_cases(spark):
    calls = spark.createDataFrame([
        (1, "a", "t", '{"n":1}', 0, "x"), (1, "a", "t", '{"n":2}', 5, "x"), (None, "a", "t", '{"n":3}', 0, "x"), (1, None, "t", "{}", 2, "x"),
        (2, "b", None, None, None, None), (2, "c", "t", '{"n":1,"after":[{"$ref":"zz"}]}', 3, "x")], CALLS)
    results = spark.createDataFrame([(1, "a", "first", 1, "x"), (1, "a", "second", 2, "x"), (None, "a", None, 9, "x"), (3, "q", "lost", 1, "x"),
                                     (3, None, "nobody", 1, "x"), (2, "c", "early", 1, "x")], RESULTS)
    rows = toolcalls.link(calls, results, SCHEMAS).collect()
    assert sorted(r.status for r in rows) == ["linked"] * 4 + ["no_id", "no_id", "no_result", "orphan_result"]
    both = {json.loads(r.line)["result"]: r for r in rows if (r.conv_id, r.call_id) == (1, "a")}
    repeats = {"call identifier repeats", "more than one result"}
    assert set(both["first"].faults) == repeats and json.loads(both["first"].line)["arguments"] == {"n": 1}
    assert set(both["second"].faults) == repeats | {"result before call"} and json.loads(both["second"].line)["arguments"] == {"n": 2}
    out = {(r.conv_id, r.call_id, r.status): r for r in rows}
    assert out[None, "a", "linked"].valid and out[2, "c", "linked"].faults == ["unknown reference zz", "result before call"]
    assert not out[2, "b", "no_result"].valid
    for r in rows:
        assert r.line == json.dumps(json.loads(r.line), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    none = toolcalls.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), SCHEMAS)
    assert none.count() == 0


FORMS = {"type": ["object", "null"], "additionalProperties": {"type": ["integer", "null"], "exclusiveMinimum": 0}, "properties": {
    "flag": {"enum": [1, "x"]}, "one": {"const": True}, "id": {"type": "string", "pattern": "^[a-z]+$"},
    "list": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"anyOf": [{"type": "string"}, {"type": "null"}]}},
    "some": {"oneOf": [{"type": "integer"}, {"type": "number"}]}}}


@pytest.mark.parametrize("text, fine", [
    ("null", True), ("{}", True), ("1", False), ('{"k":1}', True), ('{"k":null}', True), ('{"k":0}', False), ('{"k":"1"}', False),
    ('{"flag":true}', False), ('{"flag":1}', True), ('{"one":true}', True), ('{"one":1}', False), ('{"id":"ab"}', True), ('{"id":"a1"}', False),
    ('{"list":[]}', False), ('{"list":["a",null]}', True), ('{"list":[1]}', False), ('{"list":["a","b","c"]}', False),
    ('{"some":1.5}', True), ('{"some":1}', False), ('{"some":"x"}', False)])
def test_lists_of_types_and_other_keywords(text, fine):
    assert (toolcalls.check("t", text, {"t": toolcalls.checked_schema(FORMS)})[1] == []) == fine


@pytest.mark.parametrize("schema", [{"multipleOf": 2}, {"properties": {"a": {"format": "date"}}}, {"items": {"type": "int"}}, {"type": ["string", "any"]},
                                    {"anyOf": [{"not": {}}]}, {"pattern": "("}, {"additionalProperties": {"$defs": {}}}, {"items": True}])
def test_schemas_with_unknown_parts_are_refused(spark, schema):
    with pytest.raises(ValueError):
        toolcalls.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), {"t": schema})


def test_long_chains_of_references(spark):
    """A thousand calls, each referring to the one before: one task orders them. Rounds give the same."""
    calls = [(1, f"c{i}", "t", json.dumps({"n": i, "after": [{"$ref": f"c{i - 1}"}] if i else []}), i, "x") for i in range(1000)]
    out = toolcalls.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), SCHEMAS).collect()
    assert {r.call_id: r.level for r in out} == {f"c{i}": i for i in range(1000)}
    rnd = random.Random(2)
    edges = {(c, 100 * c + i, 100 * c + j) for c in range(4) for i in range(1, 14) for j in rnd.sample(range(i), min(i, 2))}
    edges |= {(6, 600 + i, 599 + i) for i in range(1, 20)}
    edges |= {(5, 501, 502), (5, 502, 501), (5, 503, 501), (None, 901, 900), (None, 902, 901)}
    nodes = spark.createDataFrame([(n,) for e in edges for n in e[1:]], "node long").distinct()
    df = spark.createDataFrame(list(edges), "conv_id long, node long, to long")
    got = [{r.node: r.level for r in toolcalls.levels(nodes, df, n).collect()} for n in (20_000, 0)]
    assert got[0] == got[1] and got[0][501] is got[0][503] is None and got[0][902] == 2 and got[0][619] == 19


def test_conversations_become_calls(spark):
    rows = [(1, 0, "user", "what is it"), (1, 1, "assistant", "this"), (None, 0, "user", None), (2, 0, "system", "s"), (2, 0, None, "s")]
    calls, results = toolcalls.from_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert calls.count() == 2 and results.count() == 1
    assert toolcalls.link(calls, results, toolcalls.TOOLS).count() == 2


def test_repeated_identifiers_keep_every_call_and_result(spark):
    turns = range(30)
    calls = [(1, "a", "t", json.dumps({"n": i}), 10 * i, "x") for i in turns]
    calls += [(1, "b", "t", json.dumps({"n": i, "after": [{"$ref": "a"}]}), 10 * i + 2, "x") for i in turns]
    results = [(1, "a", f"r{i}", 10 * i + 1, "x") for i in turns] + [(1, "b", f"s{i}", 10 * i + 3, "x") for i in range(33)]
    calls += [(2, "c", "t", '{"n":7}', 0, "x")] * 4                                             # identical rows
    calls += [(None, "call_0", "t", json.dumps({"n": i}), 0, "x") for i in turns]               # conversations without an id
    results += [(None, "call_0", f"u{i}", 1, "x") for i in turns]
    rows = toolcalls.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS).collect()
    lines = [json.loads(r.line) for r in rows]
    assert sorted(json.dumps(x["arguments"]) for x in lines if "arguments" in x) == sorted(json.dumps(json.loads(c[3]), sort_keys=True) for c in calls)
    assert sorted(x["result"] for x in lines if "result" in x) == sorted(r[2] for r in results)
    for x in lines:
        if x.get("conv_id") == 1 and "arguments" in x:
            assert x["result"] == "rs"["ab".index(x["call_id"])] + str(x["arguments"]["n"])
            assert x["level"] == "ab".index(x["call_id"]) and "call identifier repeats" in x["faults"]
    assert sorted(x["result"] for x in lines if x["status"] == "orphan_result" and "conv_id" in x) == ["s30", "s31", "s32"]
    assert all(x["status"] in ("no_result", "orphan_result") and x["faults"] for x in lines if "conv_id" not in x)
