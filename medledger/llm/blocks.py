"""Labels of linked rows within a block, as few links as tell the same components."""

from __future__ import annotations

import numpy as np


class BlockLabels:
    """Members of a block and the guests that are compared with them: each keeps the label of what it is linked to.

    A label is an id. `link` takes a matrix of direct links and gives back only pairs of ids that join two labels, at
    most one for each guest and each change of a member's label, never all pairs of a group.
    """

    def __init__(self, members: np.ndarray):
        self.label = members.astype(np.int64).copy()

    def link(self, guests: np.ndarray, linked: np.ndarray) -> np.ndarray:
        """linked[i, j]: guest i is linked to member j. Pairs (a, b) as rows."""
        rows, columns = linked.any(axis=1), linked.any(axis=0)
        if not rows.any():
            return np.empty((0, 2), dtype=np.int64)
        guests, linked = guests[rows], linked[np.ix_(rows, columns)]
        label, none = self.label[columns], np.iinfo(np.int64).max
        found = []
        while True:
            low = np.where(linked, label[None, :], none).min(axis=1)
            new = np.minimum(label, np.where(linked, low[:, None], none).min(axis=0))
            changed = new != label
            found.append(np.stack([label[changed], new[changed]], axis=1))
            label = new
            if not changed.any():
                break
        found.append(np.stack([guests, low], axis=1))
        self.label[columns] = label
        pairs = np.concatenate(found)
        return np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
