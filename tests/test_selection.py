import pytest

from pagestrata.plans import selection
from pagestrata.sources.nodes import explode_nodes


def icon(href=None):
    img = "<img alt='Histórico' src='/i/ico_alerta.gif?1'>"
    return f"<a href='{href}'>{img}</a>" if href else img


@pytest.fixture
def pick(pages_of):
    def run(target, index, *htmls):
        nodes = explode_nodes(pages_of(*htmls), selection.ALERT_REQUEST)
        out = selection.select_alert(selection.alert_rows(nodes), selection.alert_icons(nodes), target, index)
        return {r.page_id: (r.href, r.picked_by) for r in out.collect()}

    return run


HOST = "http://host.example"


def test_alert_by_name_then_by_index(pick):
    plain = f"<table><tr><td>Outro</td><td>{icon('/0')}</td></tr><tr><td>Alerta  Padrão -\nISSQN SP</td><td>{icon('/1')}</td></tr></table>"
    no_icon_first = f"<table><tr><td>alerta padrão - issqn</td></tr><tr><td>Alerta Padrão - ISSQN</td><td>{icon('/2')}</td></tr></table>"
    absent = f"<table><tr><td>Outro</td><td>{icon('/3')}</td></tr></table>"
    nothing = "<table><tr><td>Outro</td></tr></table>"
    two_cells = f"<table><tr><td>Alerta</td><td>Padrão - ISSQN</td><td>{icon('/4')}</td></tr></table>"
    out = pick("Alerta Padrão - ISSQN", 0, plain, no_icon_first, absent, nothing, two_cells)
    assert out == {
        0: (f"{HOST}/1", "name"),
        1: (f"{HOST}/2", "index"),  # the first match decides and has no icon
        2: (f"{HOST}/3", "index"),
        4: (f"{HOST}/4", "name"),
    }


def test_outer_row_is_met_first(pick):
    inner = f"<table><tr><td>A</td><td>{icon('/a')}</td></tr><tr><td>B</td><td>{icon('/b')}</td></tr></table>"
    assert pick("B", 0, f"<table><tr><td>{inner}</td></tr></table>")[0] == (f"{HOST}/a", "name")


def test_index_bounds_and_empty_target(pick):
    html = f"<table><tr><td>A</td><td>{icon('/a')}{icon()}</td></tr></table>"
    assert pick("", 0, html) == {0: (f"{HOST}/a", "index")}
    assert pick("  ", 1, html) == {0: (None, "index")}
    assert pick("zzz", 2, html) == {} and pick("zzz", -1, html) == {}


def test_day_rows_and_choice(pages_of):
    def row(date, button):
        return f"<tr><td><div align='center'>\n {date} </div></td><td>{button}</td></tr>"

    gif = "<a href='/g'><img src='/i/bt_ver_detalhes.gif'></a>"
    loose = "<a href='/l'><input src='bt_ver_detalhes_2.png'></a>"
    word = "<a href='/w'>Ver\n detalhes</a>"
    pages = pages_of(
        "<table>" + row("Nov 4, 2025", gif) + row("Nov 5, 2025", word + gif) + row("Nov 5, 2025", gif) + "</table>",
        "<table>" + row("Nov 5, 2025", loose) + "</table>",
        "<table>" + row("Nov 5, 2025", "") + row("Nov 5, 2025", gif) + "</table>",
        "<table>" + row("Nov 15, 2025", gif) + "<tr><td><div>Nov 5, 2025</div></td></tr></table>",
        "<table>" + row("Nov  5, 2025", word) + "</table>",
    )
    history = selection.history_rows(explode_nodes(pages, selection.HISTORY_REQUEST))
    out = {r.page_id: r.href for r in selection.select_day(history, "Nov 5, 2025").collect()}
    assert out == {0: f"{HOST}/g", 1: f"{HOST}/l", 4: f"{HOST}/w"}
