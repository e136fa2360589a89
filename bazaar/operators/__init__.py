from bazaar.operators.aggregates import (  # noqa: F401
    count_non_null, group_mean, group_sum, share_pct, value_counts, with_period,
)
from bazaar.operators.rules import association_rules, baskets, pair_rules  # noqa: F401
from bazaar.operators.joins import natural_join  # noqa: F401
from bazaar.operators.neighbours import (  # noqa: F401
    recommend, recommend_or_default, similar_users, user_product_ratings,
)
from bazaar.operators.lexicon import (  # noqa: F401
    lexicon_polarity, review_sentiment, sentiment,
)
from bazaar.operators.topk import top_k_per_group  # noqa: F401
