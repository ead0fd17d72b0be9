"""casebook: business analyses as Spark DataFrame jobs.

Layout:
  sources/    readers for the stored tables and the derived subject tables
  functions/  column-level helpers (cleaning, dates, arrays, labels)
  operators/  reusable DataFrame operators (ranking, shares, running sums, ...)
  plans/      the analyses per subject area, each a function of DataFrames
"""

__version__ = "0.1.0"
