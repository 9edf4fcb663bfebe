"""Report jobs: named input DataFrames and parameters in, named result DataFrames out."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Outputs(Mapping[str, DataFrame]):
    """The results of a job by name. Each is built when it is first asked for, and only the steps it needs are run:
    steps that several results share are written as tables once, at that moment.
    """

    def __init__(self, **makers: Callable[[], DataFrame]):
        self._makers = makers
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._makers[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)
