"""Texts for people, rendered on the driver.

Reports that list every row of a table are streams of lines, so that the driver holds one
partition at a time; samples and counts are bounded.
"""

from __future__ import annotations

import html as _html
import json
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _head(title: str, now: datetime | None) -> list[str]:
    return ["=" * 60, title, f"生成时间: {(now or datetime.now()):%Y-%m-%d %H:%M:%S}", "=" * 60, ""]


def validation_lines(stats: DataFrame, counts: DataFrame, found: DataFrame, now: datetime | None = None) -> Iterator[str]:
    """Statistics, counts by type and all issues, numbered within their type."""
    s = stats.first().asDict()
    by = {r.issue_type: r.n for r in counts.orderBy(F.desc("n"), "issue_type").collect()}
    yield from [*_head("标注验证报告", now), *(f"{k}: {v}" for k, v in s.items()), f"问题总数: {sum(by.values())}", ""]
    for kind, n in by.items():
        rows = found.where(F.col("issue_type") == kind).orderBy("file", "detail").toLocalIterator()
        yield f"  [{kind}] {n}"
        yield from (f"    {i}. {r.file}: {r.detail}" for i, r in enumerate(rows, 1))
        yield ""


def validation(stats: DataFrame, counts: DataFrame, found: DataFrame, now: datetime | None = None) -> str:
    return "\n".join(validation_lines(stats, counts, found, now))


def rechecked_lines(rows: DataFrame, now: datetime | None = None) -> Iterator[str]:
    """All confirmed problems, then all false alarms.  Only the former are numbered with a dot,
    by which ``report_problems`` knows them."""
    counts = rows.agg(F.count_if("confirmed").alias("yes"), F.count_if(~F.col("confirmed")).alias("no")).first()
    yield from [*_head("二次验证报告", now), f"确认问题: {counts.yes}", f"误报: {counts.no}", "", "【确认问题列表】"]
    yield from (f"  {i}. {r.file}: {r.character}" for i, r in enumerate(rows.where("confirmed").orderBy("file", "character").toLocalIterator(), 1))
    yield from ["", "【误报列表】"]
    yield from (f"  - {r.file}: {r.character}" for r in rows.where(~F.col("confirmed")).orderBy("file", "character").toLocalIterator())


def rechecked(rows: DataFrame, now: datetime | None = None) -> str:
    return "\n".join(rechecked_lines(rows, now))


def files_per_name(names: DataFrame) -> DataFrame:
    """(character, n, files) of the specific names."""
    return names.where("specific").groupBy("character").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("file")).alias("files"))


def final_lines(names: DataFrame, now: datetime | None = None) -> Iterator[str]:
    """All specific names with their files, then all descriptive ones, which can be ignored."""
    yield from _head("最终检查报告", now)
    for r in files_per_name(names).orderBy("character").toLocalIterator():
        yield f"{r.character} ({r.n})"
        yield from (f"    {f}" for f in r.files)
    rest = names.where(~F.col("specific"))
    yield from ["", f"【可忽略的描述性角色】({rest.count()} 个)"]
    yield from (f"  - {r.file}: {r.character}" for r in rest.orderBy("character", "file").toLocalIterator())


def final(names: DataFrame, now: datetime | None = None) -> str:
    return "\n".join(final_lines(names, now))


def duplicates_lines(rows: DataFrame, now: datetime | None = None) -> Iterator[str]:
    """All books with their counts, then all duplicates."""
    yield from _head("章节去重报告", now)
    per = rows.groupBy("book").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "book")
    yield from (f"{r.book}: {r.n}" for r in per.toLocalIterator())
    yield ""
    yield from (f"{i}. {r.file} -> {r.duplicate_of} ({r.reason})" for i, r in enumerate(rows.orderBy("book", "file").toLocalIterator(), 1))


def duplicates(rows: DataFrame, now: datetime | None = None) -> str:
    return "\n".join(duplicates_lines(rows, now))


def sampled(sample: DataFrame, found: DataFrame, now: datetime | None = None) -> str:
    """Fields, characters, issues, the first 300 characters and a checklist of each sample."""
    problems: dict[str, list[str]] = {}
    for r in found.join(sample.select("file"), "file", "left_semi").collect():
        problems.setdefault(r.file, []).append(r.detail)
    out = _head("抽样检查报告", now)
    for r in sample.orderBy("sample_no").collect():
        out.append(f"样本 {r.sample_no}: {r.file}")
        out += [f"  {k}: {r[k] or ''}" for k in ("world", "scene", "emotion", "plot", "style", "pov")]
        out += [f"  - {c.name} ({c.role}): {c.state}; {c.speech}" for c in r.characters or []]
        out += [f"  ! {p}" for p in sorted(problems.get(r.file, []))]
        body = r.body or ""
        out += [body[:300] + ("..." if len(body) > 300 else ""), "  [ ] scene  [ ] plot  [ ] characters  [ ] emotion  [ ] style", ""]
    return "\n".join(out)


SCORES = ("scene_score", "plot_score", "character_score", "emotion_score", "style_score", "overall_score")


def review_page(sample: DataFrame) -> str:
    """A page on which samples are scored from 1 to 5 and the scores saved as JSON.

    Scores live in the page's memory and the browser's store; a click on the same score takes
    it away; a counter shows how many samples have an overall score, a button leads to the
    first that has none.
    """
    e = _html.escape
    parts = []
    for r in sample.orderBy("sample_no").collect():
        fields = "".join(f"<dt>{k}</dt><dd>{e(str(r[k] or ''))}</dd>" for k in ("world", "scene", "emotion", "plot", "style", "pov"))
        people = "".join(f"<li>{e(c.name or '')} ({e(c.role or '')}): {e(c.state or '')}; {e(c.speech or '')}</li>" for c in r.characters or [])
        marks = "".join(f'<p class="score" data-key="{k}">{k} ' + "".join(f'<button data-value="{v}">{v}</button>' for v in range(1, 6)) + "</p>" for k in SCORES)
        parts.append(f'<section data-no="{r.sample_no}"><h2>{r.sample_no}. {e(r.file)}</h2><dl>{fields}</dl><ul>{people}</ul><pre>{e((r.body or "")[:3000])}</pre>{marks}<textarea data-key="comment"></textarea></section>')
    script = """
const kept = 'review-scores', all = JSON.parse(localStorage.getItem(kept) || '{}');
const at = el => all[el.closest('section').dataset.no] ||= {};
function show() {
  let done = 0;
  document.querySelectorAll('section').forEach(s => {
    const own = all[s.dataset.no] || {};
    s.querySelectorAll('.score').forEach(p => p.querySelectorAll('button').forEach(b => b.classList.toggle('on', own[p.dataset.key] == b.dataset.value)));
    s.querySelector('textarea').value = own.comment || '';
    if (own.overall_score) done++;
  });
  document.getElementById('count').textContent = done + ' / ' + document.querySelectorAll('section').length;
  localStorage.setItem(kept, JSON.stringify(all));
}
document.addEventListener('click', ev => {
  const b = ev.target;
  if (b.dataset.value) {
    const key = b.parentNode.dataset.key, own = at(b), v = +b.dataset.value;
    if (own[key] === v) delete own[key]; else own[key] = v;
    show();
  } else if (b.id === 'next') {
    const open = [...document.querySelectorAll('section')].find(s => !(all[s.dataset.no] || {}).overall_score);
    if (open) open.scrollIntoView();
  } else if (b.id === 'save') {
    const a = document.createElement('a');
    a.href = URL.createObjectURL(new Blob([JSON.stringify(all)], {type: 'application/json'}));
    a.download = 'scores.json';
    a.click();
  }
});
document.addEventListener('input', ev => { if (ev.target.dataset.key === 'comment') { at(ev.target).comment = ev.target.value; localStorage.setItem(kept, JSON.stringify(all)); } });
document.getElementById('load').addEventListener('change', ev => ev.target.files[0].text().then(t => { Object.assign(all, JSON.parse(t)); show(); }));
show();
"""
    style = "section{border:1px solid #ccc;margin:1em;padding:1em}pre{white-space:pre-wrap}.on{background:#fc6}"
    bar = '<p><span id="count"></span> <button id="next">next</button> <button id="save">save</button> <input id="load" type="file"></p>'
    return f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>Review</title><style>{style}</style></head><body>{bar}{"".join(parts)}<script>{script}</script></body></html>'


def descriptor(entry: dict, name: str = "train") -> str:
    return json.dumps({name: entry}, ensure_ascii=False, indent=2)
