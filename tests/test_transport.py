"""The HTTP transport maps responses and failures onto the retry/outcome rules."""

from fanline.functions.http import classify_outcome, is_retryable
from fanline.operators.delivery import deliver, http_transport


def test_http_transport_results(spark):
    # defined locally so the workers receive them by value (no test import there)
    def fake_opener(req, timeout=None):
        import http.client
        import socket
        import urllib.error

        class Resp:
            status = 200

            def __enter__(self):
                return self

            def __exit__(self, *a):
                return False

        path = req.full_url.rsplit("/", 1)[-1]
        assert req.get_method() in ("POST", "PUT") and req.data.startswith(b"{")
        if path == "ok":
            return Resp()
        if path in ("e500", "e429", "e400"):
            raise urllib.error.HTTPError(req.full_url, int(path[1:]), "x", {}, None)
        if path == "slow":
            raise socket.timeout("timed out")
        if path == "drop":
            raise http.client.RemoteDisconnected("Remote end closed connection without response")
        raise ValueError("boom")

    paths = ["ok", "e500", "e429", "e400", "slow", "drop", "other"]
    rows = [("q", i, f"http://subscriber.invalid/{p}", "POST", '{"eventId":"x"}') for i, p in enumerate(paths)]
    req = spark.createDataFrame(rows, "queue string, event_id long, uri string, method string, body string")
    out = deliver(req, http_transport(opener=fake_opener))
    got = {
        r.event_id: (r.status_code, r.error_class, r.retry, r.outcome)
        for r in out.select(
            "event_id", "status_code", "error_class",
            is_retryable("status_code", "error_class", "error_message").alias("retry"),
            classify_outcome("status_code").alias("outcome"),
        ).collect()
    }
    assert got[0] == (200, None, False, "Sent")
    assert got[1] == (500, None, True, "Failed")
    assert got[2] == (429, None, True, "Failed")
    assert got[3] == (400, None, False, "Removed")
    assert got[4] == (None, "RequestTimeoutException", True, "Failed")
    assert got[5] == (None, "RuntimeException", True, "Failed")
    assert got[6] == (None, "ValueError", False, "Failed")
