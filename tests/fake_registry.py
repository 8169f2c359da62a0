"""A transport for the tests of the REST source."""

import json

RECORDS = [{"n": i, "name": f"c{i}"} for i in range(25)]


def paged(url, params):
    if params["page"] == 3:
        raise OSError("page 3 is broken")
    start = (params["page"] - 1) * params["perPage"]
    return json.dumps({"data": RECORDS[start : start + params["perPage"]], "totalCount": len(RECORDS)})


def down(url, params):
    raise OSError("no network")


def _slice(params, size=None):
    size = size or params["perPage"]
    return RECORDS[(params["page"] - 1) * size : params["page"] * size]


def bare(url, params):
    return json.dumps(_slice(params))


def zero_total(url, params):
    return json.dumps({"data": _slice(params), "totalCount": 0})


def no_head(url, params):
    return json.dumps({"Svc": [{"row": _slice(params)}]})


def xml(url, params):
    return "<r>" + "".join(f"<item><n>{r['n']}</n></item>" for r in _slice(params)) + "</r>"


def few_a_page(url, params):
    return json.dumps({"data": _slice(params, 4), "totalCount": len(RECORDS)})


def uneven(url, params):
    cuts = [0, 10, 13, 20, 25, 25]
    n = min(params["page"], 5)
    return json.dumps({"data": RECORDS[cuts[n - 1] : cuts[n]], "totalCount": len(RECORDS)})


def unpaged(url, params):
    return json.dumps(RECORDS)


def first_broken(url, params):
    if params["page"] == 1:
        raise OSError("page 1 is broken")
    return bare(url, params)


def listing(url, params):
    page = params["page"]
    if page == 4:
        raise OSError("page 4 is broken")
    body = "".join(f"<tr><td>{i}</td><td>c{page}{i}</td><td>t</td><td>p</td><td>2020</td></tr>" for i in range(2)) if page != 3 else ""
    return f'<table class="table_list"><tbody>{body}</tbody></table>'.encode()


def site(url, params):
    if "down" in url:
        raise OSError("no answer")
    head = '<meta charset="euc-kr">' if "korean" in url else ""
    return (head + f"문의 info@{url.split('/')[2]}").encode("cp949" if "korean" in url or "bare" in url else "utf-8")


def engine(url, params):
    if url == "google_cse":
        raise OSError("quota")
    return json.dumps([{"url": f"http://{url}.kr/{i}", "title": params["query"], "snippet": "s"} for i in range(3)]).encode()


def stream(url):
    yield b"a" * 10_000
    if "broken" in url:
        raise OSError("cut off")
    yield b"b"
