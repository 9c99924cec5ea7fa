"""Survivor-coalescence Viterbi for the structure of a conversation.

The cheapest edits that give the role initials ``(s?(ua)+)?`` are a shortest path over rows through four states: nothing
kept yet, after ``s``, after ``u``, after ``a``. Each state has one survivor, a leaf of a tree of backpointers. A node
that nothing refers to any more goes, a node with a single child takes it in, and as soon as all survivors share an
ancestor, the edits up to it are final and are handed out. What is held is one letter per unresolved edit of each
survivor, and no text: a survivor carries a payload of its own (a running hash, say) instead.

Among equal costs the survivor with the least complete string of edits stays. Strings are compared by the order of
the survivors: after a row's own edits the survivors' strings have equally many letters for rows and end in one, so
none is a proper prefix of another, and their order can't change any more. Two candidates differ by that order,
or, coming from one survivor, by the letters since.

The survivors of the first two states never meet the others, since everything before them is deleted. They are
dropped as soon as no end can make them the cheapest: whatever may follow "nothing kept" may follow an ``a`` too, with
one ``s`` deleted instead (4); whatever may follow ``s`` may follow ``a``.
"""

from __future__ import annotations

from collections.abc import Callable

NONE, SYSTEM, USER, ASSISTANT = range(4)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3    # costs; fixed by the contract
AFTER = {NONE: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEPT = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


class Node:
    """Letters of consecutive edits; referred to by its children (``kids``) and by survivors (``pinned``)."""
    __slots__ = ("parent", "kids", "letters", "pinned")

    def __init__(self, parent: "Node | None", letter: str):
        self.parent, self.letters = parent, [letter]
        self.kids: set[Node] = set()
        self.pinned = 0
        if parent:
            parent.kids.add(self)


class Survivor:
    """``order``: rank of its string after the last row's own edits; ``tail``: letters inserted since."""
    __slots__ = ("cost", "order", "tail", "node", "payload")

    def __init__(self, cost, order, tail, node, payload):
        self.cost, self.order, self.tail, self.node, self.payload = cost, order, tail, node, payload

    def key(self) -> tuple[int, int, str]:
        return self.cost, self.order, self.tail


class Survivors:
    """``hand_out(letters)`` gets the final edits in order. ``payload`` has ``copy()`` and ``add(role, text)``, which
    is called for every row that a survivor's edits leave or insert."""

    def __init__(self, hand_out: Callable[[list[str]], None], payload):
        self.hand_out = hand_out
        self.root = Node(None, "")
        self.best: dict[int, Survivor] = {}
        self._set(NONE, Survivor(0, 0, "", self.root, payload))
        self._insertions()

    def _set(self, state: int, s: Survivor) -> None:
        s.node.pinned += 1
        if state in self.best:
            self._release(self.best[state].node)
        self.best[state] = s

    def _release(self, node: Node) -> None:
        node.pinned -= 1
        while node is not self.root and not node.pinned and not node.kids:
            node.parent.kids.discard(node)
            node = node.parent

    def _insertions(self) -> None:
        """Rows inserted here: a user row after anything else, then an assistant row after a user row."""
        for state, sources in ((USER, (NONE, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            held = self.best.get(state)
            least, source = (held.key(), None) if held else (None, None)
            for x in sources:
                s = self.best.get(x)
                if s and (least is None or (s.cost + INSERT, s.order, s.tail + "I") < least):
                    least, source = (s.cost + INSERT, s.order, s.tail + "I"), s
            if source:
                payload = source.payload.copy()
                payload.add(ROLE[state], "")
                self._set(state, Survivor(*least, Node(source.node, "I"), payload))

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        offers: dict[int, tuple] = {}

        def offer(state: int, cost: int, letter: str, s: Survivor, out: str | None) -> None:
            new = (cost, s.order, s.tail + letter, s, out)
            if state not in offers or new[:3] < offers[state][:3]:
                offers[state] = new

        extra = TRUNCATED if truncated else 0
        kept = KEPT.get(role[:1])
        for state, s in self.best.items():
            offer(state, s.cost + DELETE, "D", s, None)
            if must_go:
                continue
            after = AFTER[state]
            if kept == after or (kept == SYSTEM and state == NONE):
                offer(kept, s.cost + extra, "K", s, role)
            offer(after, s.cost + REROLE + extra, "R", s, ROLE[after])
        old, self.best = self.best, {}
        ranked = sorted(offers, key=lambda x: offers[x][1:3])
        for rank, state in enumerate(ranked):
            cost, _, tail, s, out = offers[state]
            payload = s.payload.copy()
            if out is not None:
                payload.add(out, text)
            self._set(state, Survivor(cost, rank, "", Node(s.node, tail[-1]), payload))
        for s in old.values():
            self._release(s.node)
        for s in self.best.values():
            self._take_in(s)
        self._insertions()
        self._drop_hopeless()
        self._coalesce()

    def _take_in(self, s: Survivor) -> None:
        up = s.node.parent
        while up is not self.root and len(up.kids) == 1 and not up.pinned:
            up.letters += s.node.letters
            up.kids.clear()
            up.pinned, s.node = s.node.pinned, up
            up = up.parent

    def _drop_hopeless(self) -> None:
        a = self.best.get(ASSISTANT)
        for state, more in ((NONE, DELETE), (SYSTEM, 0)):
            if a and state in self.best and self.best[state].cost > a.cost + more:
                self._release(self.best.pop(state).node)

    def _coalesce(self) -> None:
        while not self.root.pinned and len(self.root.kids) == 1:
            (self.root,) = self.root.kids
            self.root.parent = None
            self.hand_out(self.root.letters)
            self.root.letters = []

    def nodes(self) -> int:
        """Size of the tree (the root too)."""
        n, todo = 0, [self.root]
        while todo:
            node = todo.pop()
            n += 1
            todo.extend(node.kids)
        return n

    def end(self):
        """Hands out the rest of the cheapest edits; (their cost, their payload)."""
        win = min((self.best[x] for x in (NONE, ASSISTANT) if x in self.best), key=Survivor.key)
        path, node = [], win.node
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self.hand_out(node.letters)
        return win.cost, win.payload
