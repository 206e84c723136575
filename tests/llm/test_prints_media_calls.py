import hashlib
import json
import random
import struct
import zlib

import numpy as np
import pytest

from boutlens.llm import syncmers, tiff, tool_calls


def plain_anchors(text, k, s):
    """Closed syncmers one k-mer at a time, with the operator's hash of s-mers."""
    if len(text) < k:
        return 1 if text else 0
    codes = np.array([ord(c) for c in text], np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        inner = syncmers.windows(codes, s).tolist()
    chosen = []
    for i in range(len(text) - k + 1):
        part = inner[i : i + k - s + 1]
        if part[0] == min(part) or part[-1] == min(part):
            chosen.append(i)
    return chosen


def test_anchors_equal_a_plain_search():
    r = random.Random(1)
    for n in (79, 80, 81, 500, 3000):
        text = "".join(r.choice("abcdé\U0001f600 ") for _ in range(n))
        hashes, places = syncmers.anchors(text)
        expected = plain_anchors(text, syncmers.K, syncmers.S)
        assert len(places) == expected if n < syncmers.K else places.tolist() == expected
        h, p = syncmers.parsed(syncmers.written(hashes, places))
        assert h.tolist() == hashes.tolist() and p.tolist() == places.tolist()


def test_every_text_of_1_to_320_characters_has_an_anchor():
    r = random.Random(9)
    k, s = syncmers.K, syncmers.S
    for n in range(1, 321):
        text, other = ("".join(r.choice("abcdefgh é") for _ in range(n)) for _ in range(2))
        hashes, places = syncmers.anchors(text)
        chosen = plain_anchors(text, k, s) if n >= k else []
        assert places.tolist() == (chosen or [0]) and (chosen or n < 2 * k - s - 1)
        if n >= 20:
            # unlike texts are not alike, an empty one is like none
            assert syncmers.likeness((hashes, places), syncmers.anchors(other)) < 0.5
        assert syncmers.likeness((hashes, places), syncmers.anchors("")) == 0.0
        if n >= 2 * (2 * k - s - 1):
            # the kept half has an anchor of its own
            assert syncmers.likeness((hashes, places), syncmers.anchors(text[: n - n // 2] + other[: n // 2])) > 0


def test_equal_substrings_hash_alike():
    with np.errstate(over="ignore"):
        codes = np.array([1, 2, 3, 4, 1, 2, 3, 5, 1, 2, 3, 4], np.uint64)
        for n in range(1, 13):
            got = syncmers.windows(codes, n).tolist()
            for i in range(len(got)):
                for j in range(len(got)):
                    assert (got[i] == got[j]) == (codes[i : i + n].tolist() == codes[j : j + n].tolist())
        assert syncmers.sliding_min(codes, 5).tolist() == [min(codes[i : i + 5].tolist()) for i in range(8)]


def test_edits_change_only_what_they_touch():
    r = random.Random(3)
    a = "".join(r.choice("abcdefgh ") for _ in range(4000))
    b = a[:2000] + "X" + a[2001:]
    near = syncmers.likeness(syncmers.anchors(a), syncmers.anchors(b))
    moved = syncmers.likeness(syncmers.anchors(a), syncmers.anchors("intro " * 30 + a))
    other = syncmers.likeness(syncmers.anchors(a), syncmers.anchors(a[::-1]))
    assert near > 0.9 and moved > 0.85 and other < 0.1
    assert syncmers.likeness(syncmers.anchors(""), syncmers.anchors("")) == 1.0
    assert syncmers.likeness(syncmers.anchors(""), syncmers.anchors(a)) == 0.0


def test_edited_fingerprints_equal_a_plain_version(spark, make_docs):
    r = random.Random(4)
    rows = [(i, "".join(r.choice("abcdé ") for _ in range(r.choice((0, 1, 5, 90, 700, 20000)))), "s") for i in r.sample(range(10**6), 40)]
    rows += [(2**60, None, "s"), (-4, "below", "s"), (5, "twice", "s"), (5, "twice", "s"), (None, "no id", "s")]
    # hot ids: a third of the rows each, cut by the hash of the text
    rows += [(7, f"hot {i // 2}", "s") for i in range(30)] + [(None, f"none {i // 2}", "s") for i in range(30)]
    hashes = {x.text: x.h for x in make_docs(rows).selectExpr("coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS h").collect()}
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), hashes[x[1] or ""], x[1] or ""))
    expected = []
    for (i, t, _), (_, following, _) in zip(order, [*order[1:], order[0]]):
        t, following = t or "", following or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        own, changed, other = map(syncmers.anchors, (t, edited, following))
        near = syncmers.likeness(own, changed), syncmers.likeness(own, other)
        expected.append((str(i), len(t), hashlib.sha256(edited.encode()).hexdigest(), syncmers.written(*own), syncmers.written(*changed), *near))
    got = syncmers.edited_fingerprints(make_docs(rows).repartition(7)).collect()
    assert sorted((str(g.doc_id), *g[1:]) for g in got) == sorted(expected)
    assert syncmers.edited_fingerprints(make_docs([])).count() == 0
    one = syncmers.edited_fingerprints(make_docs([(1, "alone here", "s")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"alonealone").hexdigest() or one.n_chars == 10


def test_tiff_round_trips():
    r = random.Random(5)
    for _ in range(15):
        width, height = r.choice((1, 5, 64, 100)), r.randint(1, 80)
        data = bytes(r.choice((0, 0, 7, 255, r.randrange(256))) for _ in range(width * height))
        for how in (tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS):
            for predictor in (1, 2):
                for tile in (None, (16, 32)):
                    made = tiff.encode(data, width, how, predictor, r.choice((1, 9, 1000)), tile, r.choice((None, 13)), r.choice("<>"))
                    assert b"".join(p[5] for p in tiff.decode(made)) == data
    noise = bytes(r.randrange(256) for _ in range(64 * 1500))
    assert b"".join(p[5] for p in tiff.decode(tiff.encode(noise, 64, tiff.LZW))) == noise


def test_packed_bits_of_the_format():
    packed = bytes([0xFE, 0xAA, 0x02, 0x80, 0x00, 0x2A, 0xFD, 0xAA, 0x03, 0x80, 0x00, 0x2A, 0x22, 0xF7, 0xAA])
    plain = b"\xaa\xaa\xaa\x80\x00\x2a\xaa\xaa\xaa\xaa\x80\x00\x2a\x22" + b"\xaa" * 10
    assert tiff.unpack_bits(packed) == plain and tiff.unpack_bits(tiff.pack_bits(plain)) == plain


def test_pages_with_samples_of_several_planes_and_damage(spark):
    # two samples a pixel in planes of their own, written by hand
    body = bytes([1, 2, 3, 4, 9, 8, 7, 6])
    fields = [(256, [2]), (257, [2]), (258, [8]), (259, [1]), (273, [8, 12]), (277, [2]), (278, [2]), (279, [4, 4]), (284, [2])]
    at = 8 + len(body)
    extra, table = b"", struct.pack("<H", len(fields))
    start = at + 2 + 12 * len(fields) + 4
    for tag, values in fields:
        place = values[0]
        if len(values) > 1:
            place = start + len(extra)
            extra += struct.pack(f"<{len(values)}I", *values)
        table += struct.pack("<HHII", tag, 4, len(values), place)
    planes = b"II" + struct.pack("<HI", 42, at) + body + table + struct.pack("<I", 0) + extra
    assert next(tiff.decode(planes))[5] == bytes([1, 9, 2, 8, 3, 7, 4, 6])
    good = tiff.encode(bytes(128), 64, rows_per_page=1)
    loop = bytearray(good[:8]) + struct.pack("<H", 0) + struct.pack("<I", 8)
    struct.pack_into("<I", loop, 4, 8)
    rows = [(1, good), (2, good[:-20]), (3, b"GIF89a"), (4, None), (5, b""), (6, bytes(loop)), (7, good)]
    got = tiff.pages(spark.createDataFrame([(i, d, "x") for i, d in rows], "id int, file binary, tiff string"), "file").collect()
    assert sum(r.id == 1 for r in got) == 2 and sum(r.id == 7 for r in got) == 2
    assert all(any(r.id == i and r.tiff_page.error for r in got) for i in (2, 3, 6)) and not any(r.id in (4, 5) for r in got)


def test_headers_that_claim_too_much_are_errors(spark):
    def claims(width, height, how=tiff.NONE):
        made = bytearray(tiff.encode(bytes(64), 64, how))
        at = struct.unpack_from("<I", made, 4)[0]
        for i in range(struct.unpack_from("<H", made, at)[0]):
            tag = struct.unpack_from("<H", made, at + 2 + 12 * i)[0]
            if tag in (tiff.WIDTH, tiff.LENGTH, tiff.ROWS_PER_STRIP):
                struct.pack_into("<I", made, at + 10 + 12 * i, {tiff.WIDTH: width}.get(tag, height))
        return bytes(made)

    bomb = tiff.encode(bytes(64 * 100_000), 64, tiff.DEFLATE, rows_per_strip=100_000)
    files = [claims(64, 1 << 31), claims(1 << 31, 1 << 31, tiff.DEFLATE), claims(0, 5), claims(64, 2), bomb, tiff.encode(bytes(64 * 900), 64, rows_per_page=1)]
    df = spark.createDataFrame(list(enumerate(files)), "id int, tiff_page binary")
    got = tiff.pages(df, "tiff_page").collect()
    assert all(r.tiff_page.error for r in got if r.id < 4) and len({r.id for r in got}) == 6
    assert sum(r.id == 5 for r in got) == 900 and next(len(r.tiff_page.pixels) for r in got if r.id == 4) == 6_400_000


def test_fields_have_the_types_of_the_format():
    made = tiff.encode(bytes(128), 64, tiff.LZW, 2, order=">")
    at = struct.unpack_from(">I", made, 4)[0]
    kinds = {t: k for t, k in (struct.unpack_from(">HH", made, at + 2 + 12 * i) for i in range(struct.unpack_from(">H", made, at)[0]))}
    assert list(kinds) == sorted(kinds) and {kinds[t] for t in (258, 259, 262, 277, 296, 317)} == {3} and kinds[282] == kinds[283] == 5
    assert next(tiff.decode(made))[5] == bytes(128)


def test_media_query_is_lossless(spark, make_docs, tmp_path):
    from boutlens.llm.queries import op10_tiff

    rows = [(1, "a" * 63 + "é", "s"), (2, None, "s"), (3, "", "s"), (4, "x" * 64, "s"), (5, "long " * 30000, "s"), (5, "long " * 30000, "s")]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = op10_tiff(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for g in got:
        data = (dict((i, t) for i, t, _ in rows)[g.doc_id] or "").encode()
        payload = data + bytes(max(1, -(-len(data) // 64)) * 64 - len(data))
        assert (g.n_bytes, g.payload_bytes, g.payload_sha256, g.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert len({(g.media_sha256, g.feature) for g in got if g.doc_id == 5}) == 1
    make_docs([]).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert op10_tiff(spark, str(tmp_path / "none")).count() == 0


def test_calls_are_linked_ordered_and_checked(spark):
    calls = [("c", 5, "x", "add", '{"b":2,"a":1}', ["y"]), ("c", 9, "y", "add", '{"a":1.5}', None), ("c", 6, "z", "add", "not json", ["gone"]), ("c", 1, "u", "none", "{}", ["v"]),
             ("c", 1, "v", "none", "{}", ["u"]), ("c", 7, "x", "add", '{"a":9}', None), (None, 1, "n", "add", "{}", None), ("d", 1, None, "add", "{}", None)]
    results = [("c", 6, "x", "three"), ("c", 8, "x", "late"), ("c", 2, "lost", None), ("d", 3, "x", "other conversation")]
    schema = json.dumps({"type": "object", "required": ["a"], "properties": {"a": {"type": "integer"}, "b": {"type": "number", "maximum": 5}}, "additionalProperties": False})
    got = {(r.conv_id, r.call_id): r for r in tool_calls.link_tool_calls(
        spark.createDataFrame(calls, "conv_id string, turn int, call_id string, name string, arguments string, needs array<string>"),
        spark.createDataFrame(results, "conv_id string, turn int, call_id string, content string"),
        spark.createDataFrame([("add", schema)], "name string, schema string"),
    ).collect()}
    assert {k: r.status for k, r in got.items()} == {("c", "x"): "linked", ("c", "y"): "unanswered", ("c", "z"): "unanswered", ("c", "u"): "unanswered", ("c", "v"): "unanswered", ("c", "lost"): "orphan", ("d", "x"): "orphan"}
    x = got["c", "x"]
    assert x.repeats == 2 and x.level == 1 and x.problems == [] and x.json == '{"arguments":{"a":1,"b":2},"id":"x","name":"add","result":"three"}'
    assert got["c", "y"].problems == ["$.a: not of type integer"] and got["c", "z"].problems == ["$: not JSON"] and got["c", "u"].problems == ["no schema"]
    order = [k[1] for k, r in sorted(((k, r) for k, r in got.items() if r.position is not None), key=lambda kr: kr[1].position)]
    assert order[:3] == ["z", "y", "x"] and got["c", "u"].cyclic and got["c", "v"].cyclic
    empty = spark.createDataFrame([], "conv_id string, turn int, call_id string, name string, arguments string, needs array<string>")
    none = spark.createDataFrame([], "conv_id string, turn int, call_id string, content string")
    assert tool_calls.link_tool_calls(empty, none, spark.createDataFrame([], "name string, schema string")).count() == 0


def test_schemas():
    rule = {"type": "array", "items": {"type": ["string", "null"], "enum": ["a", None]}}
    assert tool_calls.problems(["a", None], rule) == [] and tool_calls.problems(["b", 1], rule) == ["$[0]: not one of the values allowed", "$[1]: not of type string|null"]
    assert tool_calls.problems(True, {"type": "integer"}) and not tool_calls.problems(2.0, {"type": "integer"})


def test_checks_of_bad_schemas_and_surrogates_are_problems(spark):
    good, deep = '{"type":"object"}', "[" * 100_000
    rows = [
        ("a", "t", '{"x":"\\ud800"}', good, None), ("b", "t", "{}", '{"type":"thing"}', None), ("c", "t", "{}", "[1]", None),
        ("d", "t", "{}", '{"properties":{"x":{"minimum":"1"}}}', None), ("e", "t", "{}", "not json", None), ("f", "t", deep, good, None),
        ("g", "t", '{"x":NaN}', good, None), ("h", "t", '{"\\udfff":1}', '{"additionalProperties":false}', "r"), ("i", None, None, None, None),
        ("j", "t", "{}", '{"required":[1]}', None), ("k", "t", "{}", '{"items":{"type":["string",3]}}', None),
    ]
    df = spark.createDataFrame(rows, "id string, name string, arguments string, schema string, result string")
    got = {r.id: r.j for r in df.select("id", tool_calls.checked(*(df[c] for c in df.columns)).alias("j")).collect()}
    assert got["a"].json == '{"arguments":{"x":"\\ud800"},"id":"a","name":"t","result":null}' and got["a"].problems == []
    assert all(got[k].problems == ["schema: not usable"] for k in "bcdejk")
    assert got["f"].problems == ["$: not JSON"] and got["g"].problems == ["$: not canonical"]
    assert got["h"].problems == ["$.\\udfff: not allowed"] and got["i"].problems == ["$: not JSON", "no schema"]
    for r in got.values():
        json.loads(r.json)


def test_deep_dependencies_have_levels(spark):
    ids = [f"k{i}" for i in range(12)]
    calls = [("c", i, k, "t", "{}", [ids[i // 2], ids[max(0, i - 3)]]) for i, k in enumerate(ids)]
    level = {}
    for i, k in enumerate(ids):
        level[k] = max((level[n] + 1 for n in calls[i][5] if n != k), default=0)
    got = tool_calls.link_tool_calls(
        spark.createDataFrame(calls, "conv_id string, turn int, call_id string, name string, arguments string, needs array<string>"),
        spark.createDataFrame([], "conv_id string, turn int, call_id string, content string"),
        spark.createDataFrame([("t", "{}")], "name string, schema string"),
    ).collect()
    assert {r.call_id: r.level for r in got} == level and max(level.values()) >= 4
    assert [r.call_id for r in sorted(got, key=lambda r: r.position)] == sorted(ids, key=lambda k: (level[k], ids.index(k)))
