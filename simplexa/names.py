"""Column-role names shared by the operators.

Fixed values: these names and candidate lists are part of the file formats the
library reads, so they are stated as they occur there.
"""

SAMPLE = "Sample"
FEATURE = "FeatureID"
VALUE = "Value"
SEPARATOR = "|"

LINEAGE_LEVELS = ("Kingdom", "Phylum", "Class", "Order", "Family", "Genus", "Species")

ITEM_ID_NAMES = (
    "OTU/ASV_ID", "ASV_ID", "OTU_ID", "#OTU ID", "sequence", "feature-id",
    "Feature ID", "#ASV_ID", "normalized",
)
SAMPLE_ID_NAMES = (
    "Sample", "SampleID", "sample", "sampleID", "sample_id", "SAMPLE",
    "#SampleID", "sample_name",
)
VALUE_NAMES = ("abundance", "count", "value", "total_pgpt_abundance")
NULL_TOKENS = ("NA", "nan", "null", "")
METADATA_NULL_TOKENS = ("NA", "nan", "NaN", "null", "")


def first_present(columns, candidates, what):
    """The first candidate name that occurs among ``columns``."""
    for name in candidates:
        if name in columns:
            return name
    raise ValueError(f"{what} column not found; expected one of {list(candidates)}")
