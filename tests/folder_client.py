"""A client for tests that writes each task's puts to a parquet file in a folder. Not a store:
it keeps what one upsert writes and knows nothing of keys that were there before."""

import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq

from tableflow.sinks.keyvalue import StoreClient


class FolderClient(StoreClient):
    def __init__(self, options, task):
        super().__init__(options, task)
        self.folder, self.batches = options["path"], []

    def put(self, batch):
        self.batches.append(batch)

    def delete(self, keys):
        with open(os.path.join(self.folder, f"deleted-{uuid.uuid4().hex}"), "w") as file:
            file.write("\n".join(keys.to_pylist()))

    def close(self, failed):
        if self.batches and not failed:
            pq.write_table(pa.Table.from_batches(self.batches),
                           os.path.join(self.folder, f"part-{self.task:05d}.parquet"))
