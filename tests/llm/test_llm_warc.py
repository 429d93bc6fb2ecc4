"""Archives: round trips, revisits, and salvage of damaged bytes."""

import base64
import gzip
import hashlib

import pytest

from trendlake.llm import warc

PAGE = "page_id long, url string, html string, first string, n string, digest string, revisit string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "f", "n", "d", "r") for i, u, h in rows], PAGE)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows):
    out = []
    for i, _, h in rows:
        ids = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        first = min(ids) if ids else None
        copy = first is not None and i != first
        out.append((i, len((h or "").encode()), digest(h), "revisit" if copy else "response", first if copy else None))
    return sorted(out, key=repr)


AWKWARD = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/?x=%20 y", "<p>one</p>"), (3, None, None), (4, "u", ""),
    (5, "u\r\nWARC-Type: gap", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (6, "é", "日本 \u0000 \r\n\r\n" * 3),
    (None, "u", "<p>one</p>"), (None, "u", "only null"), (None, "v", "only null"), (7, "u", "twice"), (7, "u", "twice"),
    (8, "u", "twice"), (-9, "u", "WARC/1.1\r\n"), (10, "u", "x" * 3_000_000), (11, "u", "\x1f\u008b\b")]


def test_round_trip(spark):
    got = warc.archive_pages(pages(spark, AWKWARD), payload=True).collect()
    assert all(r.gap is None for r in got)
    rows = [(r.page, r.payload_bytes, r.payload_digest, r.type, r.first) for r in got]
    assert sorted(rows, key=repr) == expected(AWKWARD)
    text = {i: h or "" for i, _, h in AWKWARD if i is not None}
    for r in got:
        if r.type == "response" and r.page is not None:
            assert bytes(r.payload).decode() == text[r.page]
        if r.type == "revisit":
            assert bytes(r.payload) == b""
    assert {r.page: r.target for r in got}[5] == "u%0D%0AWARC-Type:%20gap"


def test_threshold_and_text_ids(spark):
    df = spark.createDataFrame([("b/ +%", "u", "same text"), ("a b", "u", "same text"), ("c", "u", "s"), ("d", "u", "s")],
                               "page_id string, url string, html string")
    got = {r.page: (r.type, r.first) for r in warc.archive_pages(df, threshold=5).collect()}
    assert got == {"b/ +%": ("revisit", "a b"), "a b": ("response", None), "c": ("response", None), "d": ("response", None)}


def test_empty_table(spark):
    assert warc.archive_pages(pages(spark, [])).count() == 0


def test_many_small_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    monkeypatch.setattr(warc, "SLICE_BYTES", 300)
    rows = [(i, "u", f"page {i % 70} " * 5) for i in range(200)]
    got = warc.archive_pages(pages(spark, rows)).collect()
    assert sorted(((r.page, r.payload_bytes, r.payload_digest, r.type, r.first) for r in got), key=repr) == expected(rows)
    assert len({r.path for r in got}) >= 16


def test_archive_is_plain_gzip(spark, tmp_path):
    """Any gzip reader sees one WARC file."""
    warc.write_archives(pages(spark, AWKWARD[:6]).coalesce(1), str(tmp_path / "w"))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "w").glob("part-*")))
    plain = list(warc.salvage(data))
    assert [x[0] for x in plain] == ["record"] * 6
    assert sorted(x[3]["payload_digest"] for x in plain) == sorted(digest(h) for _, _, h in AWKWARD[:6])


# --- salvage ---------------------------------------------------------------------

RECORDS = [warc.build(str(i), f"http://h/{i}", f"text {i} ".encode() * 40) for i in range(5)]
MEMBERS = [warc.member(r) for r in RECORDS]


def read(data):
    out = list(warc.salvage(data))
    return [x[3]["record_id"][9:] for x in out if x[0] == "record"], [x[1:] for x in out if x[0] == "gap"]


def starts(parts):
    at = [0]
    for p in parts:
        at.append(at[-1] + len(p))
    return at


@pytest.mark.parametrize("parts", [MEMBERS, RECORDS], ids=["members", "plain"])
def test_flipped_byte_costs_one_record(parts):
    at = starts(parts)
    for offset in range(0, len(parts[2]), 7):
        data = bytearray(b"".join(parts))
        data[at[2] + offset] ^= 0x41
        ids, gaps = read(bytes(data))
        # bytes that no check covers (a date, a gzip time) may change a record without harm
        assert ids in (["0", "1", "3", "4"], ["0", "1", "2", "3", "4"])
        assert [g[:2] for g in gaps] == ([(at[2], at[3])] if len(ids) == 4 else [])


@pytest.mark.parametrize("parts", [MEMBERS, RECORDS], ids=["members", "plain"])
def test_cut_bytes_and_junk(parts):
    at = starts(parts)
    whole = b"".join(parts)
    assert read(whole) == (["0", "1", "2", "3", "4"], [])
    ids, gaps = read(whole[:at[1] + 20] + whole[at[2] - 9:])        # a hole inside record 1
    assert ids == ["0", "2", "3", "4"] and [g[:2] for g in gaps] == [(at[1], at[1] + 29)]
    ids, gaps = read(whole[:-5])                                     # the end is missing
    assert ids == ["0", "1", "2", "3"] and [g[:2] for g in gaps] == [(at[4], len(whole) - 5)]
    ids, gaps = read(b"junk\x1f\x8b\x08 more\n" + whole + b"\x00tail")
    assert ids == ["0", "1", "2", "3", "4"]
    assert [g[:2] for g in gaps] == [(0, 13), (13 + len(whole), len(whole) + 18)]
    assert read(b"") == ([], []) and read(b"nothing here") == ([], [(0, 12, "no version line")])


@pytest.mark.parametrize("why, old, new", [
    ("length does not fit", b"\r\nContent-Length: ", b"\r\nContent-Length: 9"),
    ("block digest differs", b"text 1 text", b"text 1 teXt"), ("head lacks a field", b"WARC-Record-ID", b"WARC-Recall-ID")])
def test_gap_names_the_failed_check(why, old, new):
    at = RECORDS[1].rindex(old) if old.startswith(b"text") else RECORDS[1].index(old)
    bad = RECORDS[1][:at] + new + RECORDS[1][at + len(old):]
    ids, gaps = read(RECORDS[0] + bad + RECORDS[2])
    assert ids == ["0", "2"] and [g[2] for g in gaps] == [why]


def test_several_records_in_a_member():
    bad = RECORDS[1].replace(b"text 1 text", b"text 1 teXt")
    data = warc.member(RECORDS[0] + bad + RECORDS[2]) + MEMBERS[3] + warc.member(bad) + MEMBERS[4]
    ids, gaps = read(data)
    assert ids == ["0", "2", "3", "4"]
    assert [g[2] for g in gaps] == ["inside the member: block digest differs"] * 2


def test_embedded_records_are_payload():
    inner = b"".join(RECORDS[:2])
    data = warc.build("9", "u", b"before\n" + inner) + RECORDS[3]
    assert read(data) == (["9", "3"], [])


def test_archives_in_a_folder(spark, tmp_path):
    bad = bytearray(b"".join(MEMBERS))
    bad[len(MEMBERS[0]) + 40] ^= 0xFF
    (tmp_path / "a.warc.gz").write_bytes(bytes(bad))
    (tmp_path / "b.warc").write_bytes(b"".join(RECORDS[3:]))
    (tmp_path / "c.warc").write_bytes(b"")
    got = warc.read_archives(spark, str(tmp_path)).collect()
    by = lambda end: sorted((r.start, r.record_id or r.gap[:17]) for r in got if r.path.endswith(end))
    at = starts(MEMBERS)
    assert by("a.warc.gz") == [(at[0], "urn:page:0"), (at[1], "member is damaged"), (at[2], "urn:page:2"),
                               (at[3], "urn:page:3"), (at[4], "urn:page:4")]
    assert [x for _, x in by("b.warc")] == ["urn:page:3", "urn:page:4"] and by("c.warc") == []
