"""Least cuts between two terminals, for graphs of one page."""

from __future__ import annotations

from collections import deque


def source_side(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling of least cost: which nodes lie on the source side.

    Node ``i`` pays ``costs[i]`` on the sink side if that is positive, and
    ``-costs[i]`` on the source side if it is negative; an edge whose ends are
    on different sides pays its weight. Among labellings of equal cost the one
    with the fewest nodes on the source side is returned.

    A node whose own cost exceeds the weights of all its edges is decided by it
    in every best labelling; such nodes are settled first, which changes the costs
    of their neighbours, and the flow runs over what is left.
    """
    near: list[dict[int, float]] = [{} for _ in costs]
    for a, b, weight in edges:
        if a != b and weight > 0:
            near[a][b] = near[a].get(b, 0.0) + weight
            near[b][a] = near[b].get(a, 0.0) + weight
    own = list(costs)
    pull = [sum(around.values()) for around in near]
    side: list[bool | None] = [None] * len(own)
    waiting = deque(i for i in range(len(own)) if abs(own[i]) > pull[i])
    while waiting:
        i = waiting.popleft()
        if side[i] is not None:
            continue
        side[i] = own[i] > 0
        for j, weight in near[i].items():
            if side[j] is None:
                own[j] += weight if side[i] else -weight
                pull[j] -= weight
                # Sums leave a trace of rounding.
                if abs(own[j]) > pull[j] + 1e-9:
                    waiting.append(j)
    left = [i for i, decided in enumerate(side) if decided is None]
    if left:
        reached = _reached(left, own, near, side)
        for i in left:
            side[i] = i in reached
    return side


def _reached(left: list[int], own: list[float], near: list[dict[int, float]], side: list) -> set[int]:
    """The nodes that the source still reaches after the greatest flow (Dinic's algorithm)."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {source: {}, sink: {}}
    for i in left:
        room[i] = {j: weight for j, weight in near[i].items() if side[j] is None}
    for i in left:
        if own[i] > 0:
            room[source][i], room[i][source] = own[i], 0.0
        elif own[i] < 0:
            room[i][sink], room[sink][i] = -own[i], 0.0
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            i = queue.popleft()
            for j, free in room[i].items():
                if free > 1e-9 and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if sink not in level:
            return set(level) - {source}
        onward = {i: iter(room[i]) for i in level}
        path = [source]
        while path:
            i = path[-1]
            if i == sink:
                flow = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= flow
                    room[b][a] += flow
                full = next(k for k, (a, b) in enumerate(zip(path, path[1:])) if room[a][b] <= 1e-9)
                # The edge that is full now is the last one tried from its start.
                del path[full + 1 :]
                continue
            for j in onward[i]:
                if level.get(j) == level[i] + 1 and room[i][j] > 1e-9:
                    path.append(j)
                    break
            else:
                path.pop()
