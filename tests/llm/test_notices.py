"""Notices and requests for a text that stand in no list, and descriptions that look like them."""

import pytest

from docstrata.llm import notices, residue

#: Written without looking at the lists of notices.py, and not used to complete them: 116 of 134 were found at first. The
#: misses led to rules, not entries: function words of all languages weigh nothing, words may border on characters of East
#: Asian scripts, one part may be a sentence. So what is found now is a regression figure, not a held-out one.
HELD_OUT = {
    "en": ["The picture could not be displayed.", "Database connection failed", "Sorry, this content is blocked in your country.", "We were unable to retrieve the requested figure.", "Your login has expired. Please sign in once more.", "JavaScript must be enabled to see this chart.", "Allow cookies in your browser to proceed.", "The document you requested has been deleted.", "Network error: connection lost", "Upload failed. Retry?", "This browser does not support WebGL.", "Image missing", "Insert your description of the image here", "Please write a caption for this figure", "Alt text goes here"],
    "de": ["Das Bild konnte nicht geladen werden.", "Die angeforderte Datei wurde nicht gefunden.", "Bitte aktivieren Sie Cookies in Ihrem Browser.", "Fehler beim Laden der Abbildung", "Ihre Sitzung ist abgelaufen. Bitte melden Sie sich erneut an.", "Zugriff auf diese Seite verweigert", "Der Server ist derzeit nicht erreichbar.", "JavaScript ist deaktiviert.", "Hier Bildbeschreibung eingeben", "Verbindung zum Server fehlgeschlagen", "Beschreibung folgt"],
    "fr": ["Ce contenu nécessite JavaScript.", "L'image n'a pas pu être chargée.", "Fichier introuvable", "Votre session a expiré. Veuillez vous connecter.", "Une erreur inattendue est survenue.", "Accès interdit", "Veuillez accepter les cookies pour continuer.", "Le serveur est momentanément indisponible.", "Insérez une description ici", "Échec du chargement de l'image", "Légende à venir"],
    "es": ["No se pudo cargar la imagen.", "El archivo solicitado no existe.", "Su sesión ha caducado.", "Active las cookies en su navegador para continuar.", "Error al cargar la página", "El servicio no está disponible en este momento.", "Acceso denegado al recurso", "Se requiere JavaScript para ver este contenido.", "Escriba aquí una descripción de la imagen", "Conexión con el servidor perdida: error", "Inténtelo más tarde, por favor."],
    "pt": ["Não foi possível carregar a imagem.", "Página não encontrada", "Ocorreu um erro inesperado.", "Ative o JavaScript no seu navegador.", "Sua sessão expirou. Faça login novamente.", "Acesso negado", "Este arquivo foi removido.", "Serviço temporariamente indisponível", "Insira a legenda aqui", "Falha ao carregar o documento", "Aceite os cookies para continuar."],
    "it": ["Impossibile caricare l'immagine.", "Pagina non trovata", "Si è verificato un errore interno.", "Attiva JavaScript nel tuo browser.", "La sessione è scaduta. Accedi di nuovo.", "Accesso negato", "Il file richiesto non esiste.", "Servizio momentaneamente non disponibile", "Inserisci qui una descrizione", "Errore durante il caricamento della pagina"],
    "nl": ["De afbeelding kan niet worden geladen.", "Pagina niet gevonden", "Er is een onverwachte fout opgetreden.", "Schakel JavaScript in uw browser in.", "Uw sessie is verlopen.", "Toegang geweigerd", "Dit bestand is verwijderd.", "De server is momenteel niet beschikbaar.", "Voeg hier een bijschrift toe", "Accepteer cookies om door te gaan."],
    "sv": ["Bilden kunde inte laddas.", "Sidan hittades inte", "Ett oväntat fel har inträffat.", "Aktivera JavaScript i din webbläsare.", "Åtkomst nekad", "Sidan är inte tillgänglig just nu."],
    "pl": ["Nie można załadować obrazu.", "Nie znaleziono strony", "Wystąpił nieoczekiwany błąd.", "Włącz JavaScript w przeglądarce.", "Sesja wygasła. Zaloguj się ponownie.", "Odmowa dostępu", "Wpisz tutaj opis obrazu", "Serwer jest obecnie niedostępny."],
    "ru": ["Не удалось загрузить изображение.", "Страница не найдена", "Произошла неожиданная ошибка.", "Включите JavaScript в браузере.", "Доступ запрещён", "Сервер временно недоступен.", "Введите описание изображения", "Файл был удалён."],
    "tr": ["Görsel yüklenemedi.", "Sayfa bulunamadı", "Beklenmeyen bir hata oluştu.", "Lütfen JavaScript'i etkinleştirin.", "Erişim engellendi"],
    "zh": ["图片加载失败", "页面不存在", "无法显示该图片", "请启用JavaScript", "服务器内部错误", "您的会话已过期,请重新登录", "请输入图片说明"],
    "ja": ["画像を読み込めませんでした", "ページが見つかりません", "サーバーエラーが発生しました", "JavaScriptを有効にしてください", "アクセスが拒否されました", "ここに説明を入力してください"],
    "ko": ["이미지를 불러올 수 없습니다", "페이지를 찾을 수 없습니다", "오류가 발생했습니다", "자바스크립트를 활성화하세요", "액세스가 거부되었습니다"],
    "": ["@@CAPTION@@", "$caption", "{0}", "%s", "%(title)s", "#{image.caption}", "<<caption>>", "[CAPTION]", "%TITLE%", "Figure {0}: %s"],
}
#: True descriptions with the words of notices in them.
DESCRIPTIONS = [
    "Photograph of the failed pump beside the valve.", "Error rates of the two methods over time.", "Screenshot of a browser that shows a page with an error.", "Block diagram of the server, the database and the network.", "Cookies and milk on a table.", "A missing bolt on the left flange.", "Status display of the controller with error code E17.", "Access door with a sign that denies entry to the basin area.",
    "Failure of the bearing after 300 hours.", "Sign at the gate that reads “ACCESS DENIED”.", "Listing in which the variable $cable is set to 83.", "Broken glass on the floor of the control room.", "Sequence of requests between the client and the server.", "Blocked filter of the cooling loop.", "Expired labels on the shelf of the laboratory.", "Map of the network with the unreachable nodes in red.", "Forbidden transitions of the atom.", "Invalid regions are hatched.",
    "Fehlerhafte Schweißnaht am Kessel.", "Der Server im Rechenzentrum mit geöffneter Tür.", "Vue de la page de garde du manuscrit.", "Serveur et baie de stockage dans la salle.", "Vista del archivo histórico de la ciudad.", "Imagen de la red de distribución de agua.", "Foto do arquivo municipal de Lisboa.", "La pagina di un manoscritto del XV secolo.", "De pagina van een oud handschrift.", "Ошибка измерения в зависимости от температуры образца.", "服务器机房的照片,左侧是冷却系统和电源柜", "研究室の画像処理システムの構成図と計算の流れ",
    "Cost of $5 and a width of 30%.", "Points $x_{1}$ and $x_{2}$ on the curve.", "The set {1, 2, 3} and its subsets.",
]


def test_notices_that_stand_in_no_list():
    cases = [x for xs in HELD_OUT.values() for x in xs]
    missed = [x for x in cases if not residue.is_residue(x)]
    assert len(cases) >= 100 and len(HELD_OUT) >= 9
    assert len(missed) <= 0.1 * len(cases), missed


@pytest.mark.parametrize("language", sorted(HELD_OUT))
def test_no_language_is_left_out(language):
    assert sum(map(residue.is_residue, HELD_OUT[language])) >= 0.75 * len(HELD_OUT[language])


def test_descriptions_stay():
    assert [x for x in DESCRIPTIONS if residue.is_residue(x)] == []


def test_parts_are_lower_case_and_distinct():
    for table in (notices.FAILURES, notices.REQUESTS, notices.TECHNIQUES, notices.SUBJECTS, notices.FILLER_VERBS, notices.FILLER_OBJECTS):
        assert all(p and p == p.lower().strip() for p in notices.parts(table))
