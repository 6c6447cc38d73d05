"""tierline: multi-hop (bronze, silver, gold) data flows written with the DataFrame API."""

from tierline.session import get_session, work_folder
from tierline.sources.catalog import Workspace
from tierline.sources.versioned import VersionedTable

__all__ = ["VersionedTable", "Workspace", "get_session", "work_folder"]
