import base64
import json
from datetime import UTC, datetime

import pytest

from kgspark.sources import landing, providers, storage, transport
from kgspark.sources.transport import FetchError, Response


def test_release_and_repository():
    release = {"assets": [{"name": "a.txt", "url": "u:txt", "size": 3}, {"name": "a.json", "url": "u:json", "size": 4}, {"name": "b.json", "url": "u:b", "size": 9}]}
    web = {"https://api.github.com/repos/o/r/releases/latest": json.dumps(release).encode(), "u:json": b"[12]"}
    get = lambda url, headers, timeout: web[url]
    assert providers.release_provider({"repository": "o/r"}, get) == b"[12]"
    for bad in ({"asset_pattern": "c.json"}, {"asset_pattern": "b.json", "max_bytes": 5}, {"max_bytes": "3B"}):
        with pytest.raises(landing.SourceError):
            providers.release_provider({"repository": "o/r"} | bad, get)
    entry = {"type": "file", "content": base64.b64encode(b"inline").decode(), "encoding": "base64", "sha": "s", "download_url": "u:raw"}
    where = "https://api.github.com/repos/o/r/contents/d/f.json?ref=main"
    file = lambda e: providers.repository_provider({"repository": "o/r", "path": "d/f.json", "ref": "main"}, lambda url, h, t: {where: json.dumps(e).encode(), "https://api.github.com/repos/o/r/git/blobs/s": b"blob", "u:raw": b"raw"}[url])
    assert file(entry) == b"inline" and file(entry | {"content": ""}) == b"blob" and file(entry | {"content": "", "sha": None}) == b"raw"
    with pytest.raises(landing.SourceError):
        file({"type": "dir"})


def test_graphql():
    calls, waits = [], []

    def post(url, payload, timeout):
        calls.append(payload["variables"])
        if len(calls) == 1:
            raise OSError("away")
        at, n = payload["variables"]["offset"], payload["variables"]["limit"]
        return {"data": {"none": None, "items": [{"k": k} for k in range(5)][at : at + n]}}

    config = {"endpoint": "e", "query": "q", "batch_size": 2, "variables": {"x": 1}, "delay": 0}
    assert [x["k"] for x in json.loads(providers.graphql_provider(config, post, waits.append))] == [0, 1, 2, 3, 4]
    assert calls[0] == {"x": 1, "offset": 0, "limit": 2} and waits[0] == 1
    for reply in ({"errors": [{"message": "no"}]}, {"data": [1]}, {"data": {"a": "text"}}):
        with pytest.raises(landing.SourceError):
            providers.graphql_provider(config, lambda *a, r=reply: r, waits.append)
    with pytest.raises(landing.SourceError):
        providers.graphql_provider(config, lambda *a: (_ for _ in ()).throw(OSError("away")), waits.append)


def test_wiki():
    page = lambda k, space="Medias": f"<pageSummary><link rel='http://www.xwiki.org/rel/page' href='https://w.org/rest/wikis/xwiki/spaces/{space}/spaces/M{k % 2}/pages/P{k}'/><id>xwiki:{space}.M.P{k}</id><title>T{k}</title><rawTitle/><xwikiAbsoluteUrl>https://w.org/{k}</xwikiAbsoluteUrl></pageSummary>"
    asked = []

    def get(url, headers, timeout):
        asked.append(url)
        if url.endswith("/tags/a"):
            return f"<pages xmlns='http://www.xwiki.org'>{page(0)}{page(1)}</pages>".encode()
        if url.endswith("/tags/b%20c"):
            return f"<pages xmlns='http://www.xwiki.org'>{page(0)}{page(2)}{page(3, 'Other')}</pages>".encode()
        if "properties/site" in url:
            return json.dumps({"value": "https://m.org/x y" if "/M0/" in url else 3}).encode()
        if "/pages/P" in url:
            return b"<page xmlns='http://www.xwiki.org'><content>text</content><created>2024-01-02</created><language>fr</language></page>"
        raise OSError("away")

    found = json.loads(providers.wiki_provider({"base_url": "https://w.org", "tags": ["a", "b c", "gone"], "delay": 0}, get, lambda s: None))
    assert [(p["id"], p["title"], p["content"], p["organization_url"]) for p in found] == [(f"xwiki:Medias.M.P{k}", f"T{k}", "text", "https://m.org/x%20y") for k in (0, 2)]
    assert sum("/M0/" in u and "properties" in u for u in asked) == 1  # looked up once
    for tags in (["gone"], ["a"]):
        with pytest.raises(landing.SourceError):
            providers.wiki_provider({"base_url": "https://w.org", "tags": tags, "delay": 0}, lambda u, h, t: get(u, h, t) if "properties" not in u else b"{}", lambda s: None)


def _web(replies, addresses=("93.184.216.34",)):
    asked = []

    def requester(url, address, headers, timeout):
        asked.append((url, address, headers))
        return replies[url]

    return asked, lambda url, timeout=1, **more: transport.public_get(url, timeout, resolver=lambda h, p: list(addresses), requester=requester, **more)


def test_public_get_checks_every_hop():
    replies = {"https://a.org/": Response(302, {"Location": "/x y"}), "https://a.org/x%20y": Response(200, {}, iter([b"ok"])), "https://loop.org/": Response(301, {"location": "https://loop.org/"}), "https://out.org/": Response(302, {"Location": "ftp://z"})}
    asked, get = _web(replies)
    assert get("https://a.org/").url == "https://a.org/x%20y" and [a for _, a, _ in asked] == ["93.184.216.34"] * 2
    for url, more, kind in (("https://loop.org/", {}, "request"), ("https://out.org/", {}, "invalid_url"), ("https://u:p@a.org/", {}, "invalid_url"), ("ftp://a.org/", {}, "invalid_url"), ("https://a.org/", {"origin": "https://b.org"}, "invalid_url")):
        with pytest.raises(FetchError) as e:
            get(url, **more)
        assert e.value.kind == kind
    for addresses, kind in ((("10.0.0.1",), "invalid_url"), (("93.184.216.34", "127.0.0.1"), "invalid_url"), (("::1",), "invalid_url"), ((), "dns")):
        with pytest.raises(FetchError) as e:
            _web(replies, addresses)[1]("https://a.org/")
        assert e.value.kind == kind
    profiles = {"news.org": {"User-Agent": "n"}, "a.news.org": {"User-Agent": "a"}}
    assert [transport.headers_for(f"https://{h}/", profiles)["User-Agent"] for h in ("news.org", "b.news.org", "x.A.news.org.", "othernews.org")] == ["n", "n", "a", "kgspark"]


def test_fetch_document_names_every_outcome():
    now = datetime(2024, 1, 1, tzinfo=UTC)
    html, page = {"Content-Type": "text/html; charset=latin-1"}, "<html><link rel=canonical href='/c'><article><p>Café text here</p></article></html>".encode("latin-1")

    def outcome(reply, url="https://a.org/"):
        def get(u, timeout):
            if isinstance(reply, Exception):
                raise reply
            return reply

        return transport.fetch_document(url, get=get, now=lambda: now)

    good = outcome(Response(200, html, iter([page])))
    assert (good["content"], good["canonical_url"], good["final_url"]) == ("Café text here", "https://a.org/c", "https://a.org/") and "error_type" not in good
    assert outcome(None, "")["error_type"] == "invalid_input" and outcome(None, "ftp://x")["error_type"] == "invalid_url"
    late = outcome(Response(429, {"Retry-After": "60"}))
    assert (late["error_type"], late["http_status"], late["retry_at"].minute) == ("http_error", 429, 1)
    kinds = [(Response(200, {"Content-Type": "image/png"}), "unsupported_content"), (Response(200, html | {"Content-Length": "99999999"}), "response_too_large"), (Response(200, html, iter([b"x" * (6 << 20)])), "response_too_large")]
    kinds += [(Response(200, html, iter([b""])), "download_failed"), (Response(200, html, iter([b"<div class=cf-chl-x>"])), "access_challenge"), (Response(200, html, iter([b"<nav>menu</nav>"])), "extraction_failed")]
    kinds += [(FetchError("dns"), "dns"), (TimeoutError(), "timeout"), (ConnectionResetError(), "connection"), (ValueError(), "download_failed"), (KeyError(), "unknown"), (FetchError("request"), "request")]
    for reply, kind in kinds:
        assert outcome(reply)["error_type"] == kind
    again = [transport.worth_another_try(x) for x in ({"error_type": "timeout"}, {"error_type": "http_error", "http_status": 503}, {"error_type": "http_error", "http_status": 404}, {"error_type": "dns"}, {"content": "x"})]
    assert again == [True, True, False, False, False]


def test_files_of_a_disk_and_of_spark(spark, tmp_path):
    for disk, root in ((storage.files(None, str(tmp_path)), str(tmp_path / "a")), (storage.files(spark, f"file://{tmp_path}"), f"file://{tmp_path}/b")):
        disk.write(f"{root}/x/f", "one")
        disk.write(f"{root}/x/f", b"two")
        assert disk.read(f"{root}/x/f") == "two" and disk.exists(f"{root}/x/f") and not disk.exists(f"{root}/y")
        assert disk.create(f"{root}/lock", "1") and not disk.create(f"{root}/lock", "2") and disk.read(f"{root}/lock") == "1"
        assert [n for n in disk.names(root) if not n.startswith(".")] == ["lock", "x"] and disk.is_folder(f"{root}/x") and disk.names(f"{root}/none") == []
        assert disk.sha256(f"{root}/x/f") == "3fc4ccfe745870e2c0d99f71f30ff0656c8dedd41cc1d7d3d376b0dbe685e2f3"
        disk.rename(f"{root}/x/f", f"{root}/z/g")
        disk.delete(f"{root}/x")
        assert "g" in disk.tree(root) and not disk.exists(f"{root}/x")
    shared = landing.Landing(f"file://{tmp_path}/land", spark=spark)
    path = shared.put("s", {"k": 1}, b"[1]")
    assert str(path).startswith("file:") and shared.get("s", {"k": 1}) == path and shared.stats()["entries"] == 1 and shared.clear("s") == 1
