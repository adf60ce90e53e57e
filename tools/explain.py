"""Print the physical plan of registered queries: python tools/explain.py NAME [sf_dir] [mode]."""
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from tidemark.registry import REGISTRY  # noqa: E402
from tidemark.session import get_session  # noqa: E402

if __name__ == "__main__":
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    mode = sys.argv[3] if len(sys.argv) > 3 else "formatted"
    spark = get_session()
    REGISTRY[name](spark, sf).explain(mode)
