"""Pages of polled lists, read again from files: a batch and a stream source.

``path/poll=N/list=NAME/page=K/...`` holds one JSON text: {"page": K, "total_pages": T, "results": [...]}. Lists of many pages
lie in blocks instead: ``path/poll=N/list=NAME/pages=K/...`` has page K and those that follow it, a line each, up to the next
block. A list's first page says how many there are, and nothing beyond these is read, whatever lies there. Tasks take runs of
pages. A stream takes whole polls: its offset is the last poll that it has read.
"""

from __future__ import annotations

import io
import itertools
import json
from dataclasses import dataclass
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from strata.sources.rolling import file_system

SCHEMA = "poll long, list_name string, page int, results string"
PAGES_A_TASK = 50
#: Where there would be more tasks than this, each takes more pages than it is asked to, up to a long run.
MANY_TASKS, LONG_RUN = 256, 1000


@dataclass
class Run(InputPartition):
    """Pages of one list of one poll."""

    poll: int
    name: str
    folder: str
    first: int
    last: int


def _children(path: str, key: str) -> dict[str, str]:
    """value of key: folder, of the folders key=value below a path."""
    store, where = file_system(path)
    found = store.get_file_info(fs.FileSelector(where, allow_not_found=True))
    return {unquote(i.base_name[len(key) + 1 :]): f"{path}/{i.base_name}" for i in found if i.type == fs.FileType.Directory and i.base_name.startswith(f"{key}=")}


def _file(folder: str) -> tuple[fs.FileSystem, str | None]:
    """The store, and the first file of a folder in it; None where there is none."""
    store, where = file_system(folder)
    files = [i for i in store.get_file_info(fs.FileSelector(where, allow_not_found=True)) if i.type == fs.FileType.File and i.base_name[0] not in "._"]
    return store, min((i.path for i in files), default=None)


def _page(folder: str) -> dict | None:
    """What the page's file says; None where there is no page."""
    store, found = _file(folder)
    if found is None:
        return None
    with store.open_input_stream(found) as file:
        return json.loads(file.read())


def _block(folder: str, skip: int, n: int):
    """What n lines of a block's file say, after some others; fewer where it ends."""
    store, found = _file(folder)
    if found is not None:
        with io.TextIOWrapper(store.open_input_stream(found), encoding="utf-8", newline="\n") as lines:
            yield from map(json.loads, itertools.islice(lines, skip, skip + n))


def _pages(folder: str, first: int, last: int):
    """(K, what page K says) of a list's pages first to last; None for a page that is not there."""
    store, where = file_system(folder)
    if store.get_file_info(f"{where}/pages=1").type != fs.FileType.Directory:
        yield from ((k, _page(f"{folder}/page={k}")) for k in range(first, last + 1))
        return
    starts = sorted(int(n) for n in _children(folder, "pages"))
    for start, end in zip(starts, [*starts[1:], last + 1], strict=True):
        some = range(max(first, start), min(last + 1, end))
        if some:
            for k, page in itertools.zip_longest(some, _block(f"{folder}/pages={start}", some[0] - start, len(some))):
                yield k, page if page and page.get("page") == k else None


def polls(path: str) -> list[int]:
    return sorted(int(n) for n in _children(path, "poll"))


def planned(path: str, some: list[int], pages_a_task: int) -> list[Run]:
    """The runs of pages of some polls, by what first pages say."""
    lists = []
    for poll in some:
        for name, folder in sorted(_children(f"{path}/poll={poll}", "list").items()):
            lists.append((poll, name, folder, int((next(_pages(folder, 1, 1))[1] or {}).get("total_pages", 0))))
    n = max(pages_a_task, min(LONG_RUN, -(-sum(total for *_, total in lists) // MANY_TASKS)))
    return [Run(*said, k, min(total, k + n - 1)) for *said, total in lists for k in range(1, total + 1, n)]


def _read(run: Run | None):
    """A missing page of those that the first one announces is an error: a list without it would be ranked wrongly."""
    for k, page in _pages(run.folder, run.first, run.last) if run else ():
        if page is None:
            raise OSError(f"page {k} of {run.folder} is missing")
        yield (run.poll, run.name, k, json.dumps(page.get("results") or []))


class Reader(DataSourceReader):
    def __init__(self, path: str, pages_a_task: int) -> None:
        self.path, self.pages_a_task = path, pages_a_task

    def partitions(self) -> list[Run]:
        return planned(self.path, polls(self.path), self.pages_a_task)

    def read(self, partition: Run):
        return _read(partition)


class StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, pages_a_task: int) -> None:
        self.path, self.pages_a_task = path, pages_a_task

    def initialOffset(self) -> dict:
        return {"poll": -1}

    def latestOffset(self) -> dict:
        return {"poll": max(polls(self.path), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[Run]:
        return planned(self.path, [n for n in polls(self.path) if start["poll"] < n <= end["poll"]], self.pages_a_task)

    def read(self, partition: Run):
        return _read(partition)


class ListPages(DataSource):
    """Options: path, pages_a_task (a task has more where lists are long). Columns: poll, list_name, page, results (a JSON array as text)."""

    @classmethod
    def name(cls) -> str:
        return "list_pages"

    def schema(self) -> str:
        return SCHEMA

    def _own(self) -> tuple[str, int]:
        return self.options["path"].rstrip("/"), int(self.options.get("pages_a_task", PAGES_A_TASK))

    def reader(self, schema) -> Reader:
        return Reader(*self._own())

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(*self._own())
