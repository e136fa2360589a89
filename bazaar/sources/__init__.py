from bazaar.sources.io import read_table, write_mart, save_ratings, load_ratings  # noqa: F401
from bazaar.sources.schemas import RAW_SCHEMAS  # noqa: F401
