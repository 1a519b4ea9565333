"""A seeded generator of small career sites with known answers."""

from __future__ import annotations

BASE = "https://careers.acme.com"


def page(title: str, body: str) -> str:
    return f"<html><head><title>{title}</title></head><body>{body}</body></html>"


def listing(site: str, n: int, extra: str = "") -> str:
    items = "".join(f'<li class="job-item"><a class="job" href="/jobs/{i}">Software Engineer {i}</a></li>' for i in range(n))
    return page("Open Jobs", f'<h1>Careers</h1><nav class="menu"><a href="/about">About us all</a></nav><ul id="list">{items}</ul>{extra}')


def site(name: str = "careers.acme.com", jobs: int = 12) -> list[tuple[str, str]]:
    """(url, html): home -> careers -> jobs list -> job pages, and a page that nothing links to."""
    root = f"https://{name}"
    rows = [
        (f"{root}/", page("Acme", '<a href="/careers/?utm_source=x">Careers</a><a href="/about">About</a><a href="#top">Top</a><a>none</a>')),
        (f"{root}/careers", page("Work here", f'<a href="{root}/jobs">All jobs</a><a href="/careers?page=2">More jobs</a>')),
        (f"{root}/jobs", listing(name, jobs, '<div class="pagination"><a href="/jobs?page=2">Next</a></div>')),
        (f"{root}/lost", page("Lost", "nothing")),
    ]
    for i in range(jobs):
        rows.append((f"{root}/jobs/{i}", page(f"Job {i}", f"<h1>Software Engineer {i}</h1><p>Location: City number {i} of the large world</p><p>Skills: reading and writing of very long words</p>")))
    return rows
