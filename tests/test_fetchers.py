"""The real HTTP fetcher, without a network: ``urlopen`` is replaced."""

import io
import urllib.error
import urllib.parse

from ticksmith.sources import fetchers


class _Resp(io.BytesIO):
    status = 200

    def __enter__(self):
        return self

    def __exit__(self, *a):
        return False


def test_http_fetch_request_shape(monkeypatch):
    seen = {}

    def fake_urlopen(req, timeout=None):
        seen["url"], seen["headers"], seen["timeout"] = req.full_url, dict(req.header_items()), timeout
        return _Resp(b'{"A":{"values":[]}}')

    monkeypatch.setattr(fetchers.urllib.request, "urlopen", fake_urlopen)
    monkeypatch.setenv("TICKSMITH_API_KEY", "k123")
    status, body = fetchers.http_fetch(["AAPL", "BRK.B"], "2026-01-01", "2026-03-31", "1day", {})
    assert (status, body) == (200, '{"A":{"values":[]}}')
    base, _, query = seen["url"].partition("?")
    assert base == "https://api.twelvedata.com/time_series"
    assert urllib.parse.parse_qs(query) == {"interval": ["1day"], "start_date": ["2026-01-01"],
                                            "end_date": ["2026-03-31"], "symbol": ["AAPL,BRK.B"]}
    assert "apikey" not in seen["url"] and seen["headers"]["Authorization"] == "apikey k123"
    assert seen["timeout"] == 30.0


def test_http_fetch_keeps_error_status(monkeypatch):
    def failing(req, timeout=None):
        raise urllib.error.HTTPError(req.full_url, 429, "Too Many Requests", {}, io.BytesIO(b'{"code":429}'))

    monkeypatch.setattr(fetchers.urllib.request, "urlopen", failing)
    assert fetchers.http_fetch(["A"], "2026-01-01", "2026-01-02", "1day", {}) == (429, '{"code":429}')
