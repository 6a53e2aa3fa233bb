"""What written tables leave on the driver."""
from tabclass.llm.common import collect_garbage


def test_the_driver_collects_garbage_before_its_heap_is_full():
    class Heap:
        def __init__(self, total):
            self.total, self.collected = total, 0
            self.sparkContext = self._jvm = self.Runtime = self.System = self

        getRuntime = lambda self: self
        totalMemory = lambda self: self.total
        maxMemory = lambda self: 1000

        def gc(self):
            self.collected += 1

    assert not collect_garbage(low := Heap(400)) and low.collected == 0
    assert collect_garbage(high := Heap(700)) and high.collected == 1
