"""Options shared by the preparation and evaluation operators."""

from __future__ import annotations

from dataclasses import asdict, dataclass

# The special tokens in id order (pad 0, unk 1, bos 2, eos 3).
SPECIAL_TOKENS = ("<pad>", "<unk>", "<bos>", "<eos>")
PAD_ID = 0
UNK_ID = 1
BOS_ID = 2
EOS_ID = 3

# Fixed value: the label that marks a position as "not part of the loss".
IGNORE_ID = -100


@dataclass(frozen=True)
class PrepOptions:
    """Settings of one preparation run; the defaults are the documented ones."""

    dataset_name: str = "wmt14"
    dataset_config_name: str = "fr-en"
    dataset_fraction: float = 1.0
    source_lang: str = "fr"
    target_lang: str = "en"
    max_source_length: int = 128
    max_target_length: int = 128
    max_train_samples: int | None = None
    max_eval_samples: int | None = None
    seed: int = 42
    normalize: bool = False
    min_count: int = 1
    max_vocab_size: int | None = None
    padding: str | None = "max_length"
    batch_size: int = 32
    alignment: str = "reference"
    tokenizer_name: str = "word-vocabulary"
    overwrite_cache: bool = False

    def __post_init__(self) -> None:
        if self.alignment not in ("reference", "aligned"):
            raise ValueError(f"alignment must be 'reference' or 'aligned', not {self.alignment!r}")
        if self.padding not in ("max_length", None):
            raise ValueError(f"padding must be 'max_length' or None, not {self.padding!r}")
        if min(self.max_source_length, self.max_target_length) < 1:
            raise ValueError("maximum lengths must be at least 1")

    @property
    def cache_key(self) -> str:
        """Folder name of the processed sets: data set, pair and tokenizer."""
        name = f"{self.dataset_name}_{self.dataset_config_name}_tok_{self.tokenizer_name}"
        return name.replace("/", "_")

    def manifest(self) -> dict[str, str]:
        """Every option that changes the processed rows, as text."""
        skip = {"overwrite_cache", "batch_size", "alignment"}
        return {k: str(v) for k, v in sorted(asdict(self).items()) if k not in skip}
