import base64
import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

from postmill.llm import content_archive, host_reputation, systematic_mix
from postmill.session import scratch_path

# --- archive ----------------------------------------------------------------

PAGES = "page_id long, url string, html string, digest string, header string"


def pages():
    bodies = ["<p>one</p>", "", None, "é 日本\r\n\r\nWARC/1.1\r\n", "<p>one</p>", "x" * 5000]
    rows = [(i * 3, f"http://h{i}/é\r\nX: y", bodies[i % 6], "a", "b") for i in range(40)]
    return rows + [rows[7], rows[7], (None, "http://n/", "<p>one</p>", "a", "b"), (-4, None, "x" * 5000, "a", "b")]


def base32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_archive_index_equals_brute_force(spark):
    rows = pages()
    first = {}
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        if i is not None:
            first[body] = min(first.get(body, i), i)
    want, seen = Counter(), set()
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        response = i == first[body] and i not in seen
        seen.add(i)
        want[i, len(body), base32(body), "response" if response else "revisit", None if response else first[body]] += 1
    df = spark.createDataFrame(rows, PAGES).repartition(5)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in content_archive.archived(df).collect())
    assert got == want
    assert content_archive.archived(df.limit(0)).collect() == []


def test_records_are_given_back_with_their_payloads(spark):
    rows = pages()
    path = scratch_path(spark, "archive")
    content_archive.write_archive(spark.createDataFrame(rows, PAGES), path)
    records = content_archive.read_records(spark, path).collect()
    assert Counter((r.page_id, bytes(r.payload)) for r in records) == Counter((i, (html or "").encode()) for i, _, html, *_ in rows)
    for r in records:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        assert int(fields["Content-Length"]) == len(rest) - 4
        http, _, body = rest[:-4].partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK") and body == (b"" if r.record_type == "revisit" else bytes(r.payload))
        assert fields["WARC-Payload-Digest"] == "sha1:" + base32(bytes(r.payload))
        assert ("WARC-Refers-To" in fields) == (r.record_type == "revisit")
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == len({(html or "").encode() for _, _, html, *_ in rows})


# --- reputation -------------------------------------------------------------


def test_hosts_with_much_evidence_are_blocked_and_thin_ones_are_not(spark):
    hosts = {"bad.a.com": (60, 58), "thin.b.com": (1, 1), "good.b.com": (60, 1), "mixed.c.org": (40, 20), "none.d.org": (3, 0)}
    rows, outcomes, number = [], [], 0
    for host, (total, bad) in hosts.items():
        for i in range(total + 2):
            rows.append((number, f"http://{host.upper()}/p{i}?q#f", "x"))
            if i < total:
                outcomes.append((number, int(i < bad)))
            number += 1
    rows += [(number, None, "x"), (number + 1, "no scheme", "x"), (None, "https://bad.a.com", "x"), (number + 2, "http://new.bad.a.com/", "x")]
    outcomes += [(None, 1), (number, None), (999_999, 1)]
    got = host_reputation.verdicts(spark.createDataFrame(rows, "page_id long, url string, rule string"), spark.createDataFrame(outcomes, "page_id long, bad int"))
    by_host = defaultdict(set)
    for r in got.collect():
        by_host[r.host].add(r.verdict)
    assert by_host["bad.a.com"] == {"block"}
    assert all(by_host[h] == {"allow"} for h in ("thin.b.com", "good.b.com", "mixed.c.org", "none.d.org", ""))
    rates = {r.host: (r.bad_rate, r.bound) for r in got.collect()}
    assert 58 / 60 > rates["bad.a.com"][0] > rates["thin.b.com"][0] > rates["good.b.com"][0]
    assert all(bound < rate for rate, bound in rates.values())
    assert got.count() == len(rows)
    empty = spark.createDataFrame([], "page_id long, bad int")
    df = spark.createDataFrame(rows, "page_id long, url string, rule string")
    assert {r.verdict for r in host_reputation.verdicts(df, empty).collect()} == {"allow"}
    assert host_reputation.verdicts(df.limit(0), empty).collect() == []


def rule_of(host, path):
    fits = [r for r, _ in host_reputation.RULES if re.fullmatch(rf"(.*\.)?{re.escape(r.split('/')[0])}", host, re.S) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len, default=None)


def test_rules_come_before_the_method(spark):
    urls = ["http://x.NET/", "http://x.net", "ftp://example.net/en/a", "http://a.example.net/en", "http://example.com/de/x?y", "http://badexample.com/de/"]
    urls += ["http://w.org/fr/", "http://w.org/FR/", "http://net/", "x://example.com/de/#", "http://u:p@a.org/fr/x", "http://a.net:80/", "a://b://c.net/", "", "http://", "http:///net/", "http://É.org/fr/"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = host_reputation.verdicts(rows, spark.createDataFrame([], "page_id long, bad int")).collect()
    for r in got:
        found = re.search(r"://([^/?#]*)([^?#]*)", urls[r.page_id], re.S)
        host, path = found.groups() if found else ("", "")
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        rule = rule_of(host, path)
        verdict = dict(host_reputation.RULES).get(rule, "allow")
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


# --- mix --------------------------------------------------------------------


def targets(sizes):
    """source -> target, by raising a common level until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    whole, capped = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        left = whole - sum(2 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = {s for s in rest if share[s] > 2 * sizes[s]}
        if not above:
            return {s: float(share.get(s, 2 * sizes[s])) for s in order}
        capped |= above


def test_mix_meets_its_targets(spark):
    rows = []
    for k, source in enumerate(["a", "b", "B", "é", "", None, "zero"]):
        for i in range(30 * (k + 1)):
            words = 0 if source == "zero" else (i * 7) % 40
            rows.append((len(rows), " \n".join(["wörd"] * words) if words or i % 2 else None, source, "x"))
    rows += [rows[5]] * 3 + [(None, "no id here", "a", "x")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies string")
    got = systematic_mix.mix_report(df.repartition(7)).collect()
    sizes = defaultdict(int)
    for _, text, source, _ in rows:
        sizes[source] += len((text or "").split())
    want = targets(sizes)
    by_doc = {d: (s, len((t or "").split())) for d, t, s, _ in rows}
    taken = defaultdict(int)
    for r in got:
        source, size = by_doc[r.doc_id]
        assert r.size == size and r.source_size == sizes[source] and abs(r.target - want[source]) < 1e-6
        assert r.taken in (0, size, 2 * size)
        taken[source] += r.taken
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 0.05 * want[s] + 45 for s in sizes)
    again = systematic_mix.mix_report(df.repartition(2)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    mixed = systematic_mix.mixed_documents(df)
    assert mixed.columns == df.columns
    words = defaultdict(int)
    for r in mixed.collect():
        words[r.source] += len((r.text or "").split())
    assert words == {s: n for s, n in taken.items() if s in words} and systematic_mix.mix_report(df.limit(0)).collect() == []
