"""blogscope: what groups of people write about, as Spark DataFrame jobs.

Subpackages
-----------
functions  column expressions (text clean-up, labels, bag-of-words, vectors)
sources    readers/writers, raw blog files, driver-table adapters
operators  segments, terms/TF-IDF, phrases, language, taxonomy, topic models
plans      end-to-end jobs (TF-IDF path, LDA path, reports)
streaming  incremental and streaming variants
"""

from .session import get_session  # noqa: F401
